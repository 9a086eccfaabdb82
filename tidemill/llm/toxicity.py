"""Operator 1, toxicity: multiple-instance learning with noisy-or.

Only documents carry labels. A sentence's probability is logistic in its words'
weights, and a document is toxic if any sentence is: 1 minus the product of
the sentences' complements. The gradient of the document's likelihood flows
through that noisy-or to the sentences, so the same model that scores
documents also says which sentences offend.

The model is fitted in one task on a bounded sample of labelled rows: of each
class the documents of least hashed id, about ``SAMPLE`` rows. Weights are kept
sparse by soft thresholding; scoring reads whole texts.

Defined results: a null or empty text, or one without words, scores 0; without
labelled rows of both classes every score is 0; null labels are not learned
from; a document labelled twice counts as toxic if any label says so; repeated
rows score alike; very long texts are scored sentence by sentence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import WordCache, arrow_schema, documents, hash_share, held_out, id_and_text, labels, map_rows, record_batch

#: Labelled rows that the model is fitted on, about: toxic ones, others.
SAMPLE = 1500, 3000
#: Documents of the sample that must hold a feature.
LEAST_DOCS = 3
STEPS, RATE, L1 = 80, 0.15, 1e-3
#: Features of less weight than this are left out before the rest is fitted anew, without thresholding.
LEAST_WEIGHT, AGAIN_STEPS = 0.8, 300
THRESHOLD = 0.7

_sentences = re.compile(r"[^.!?\n]+")
_words = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings of four and five letters."""
    return [word, *(word[:n] + "-" for n in (4, 5) if len(word) >= n)]


def fit_noisy_or(texts: list[str], marks: list[int], steps: int = STEPS, rate: float = RATE, l1: float = L1) -> dict[str, float]:
    """Weights by feature; the bias under the empty string. Empty if a class is missing."""
    if not 0 < sum(marks) < len(marks):
        return {}
    split = [[set(_words.findall(s)) for s in _sentences.findall(t.lower())] for t in texts]
    seen: dict[str, int] = {}
    features = WordCache(word_features)
    for sentences in split:
        for f in {f for words in sentences for w in words for f in features[w]}:
            seen[f] = seen.get(f, 0) + 1
    names = [f for f, n in seen.items() if n >= LEAST_DOCS]
    number = {f: k for k, f in enumerate(names)}
    numbers = WordCache(lambda w: [number[f] for f in features[w] if f in number])
    ids: list[int] = []
    starts, owner = [], []
    for doc, sentences in enumerate(split):
        for words in sentences:
            found = [k for w in words for k in numbers[w]]
            if found:
                starts.append(len(ids))
                owner.append(doc)
                ids += found
    y = np.array(marks, float)
    wordy = np.array([sum(1 for words in sentences if words) for sentences in split], float)
    if not ids:
        return {}
    instances = np.array(ids, np.int32), np.array(starts), np.array(owner)
    w = _descend(*instances, y, wordy, np.append(np.zeros(len(names)), -5.0), steps, rate, l1)
    kept = np.flatnonzero(np.abs(w[:-1]) > LEAST_WEIGHT)
    if not len(kept):
        return {"": float(w[-1])}
    w = _descend(*_only(*instances, kept, len(names)), y, wordy, np.append(w[kept], w[-1]), AGAIN_STEPS, rate / 2, 0.0)
    return {"": float(w[-1])} | {names[k]: float(v) for k, v in zip(kept, w, strict=False)}


def _only(at: np.ndarray, starts: np.ndarray, owner: np.ndarray, kept: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sentences reduced to the kept features; those that lose all go."""
    place = np.full(n, -1)
    place[kept] = np.arange(len(kept))
    new = place[at]
    sentence = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at))))[new >= 0]
    left, first = np.unique(sentence, return_index=True)
    return new[new >= 0], first, owner[left]


def _descend(at: np.ndarray, starts: np.ndarray, owner: np.ndarray, y: np.ndarray, wordy: np.ndarray, w: np.ndarray, steps: int, rate: float, l1: float) -> np.ndarray:
    """Adam on the noisy-or likelihood. Sentences without a feature have the bias only; they are counted, not listed."""
    n = len(w) - 1
    plain = wordy - np.bincount(owner, minlength=len(y))
    sizes = np.diff(np.append(starts, len(at)))
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))) / len(y)
    w, first, second = w.copy(), np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(w[at], starts) + w[-1], -30, 30)))
        base = 1 / (1 + np.exp(-np.clip(w[-1], -30, 30)))
        clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)) + plain * np.log1p(-base)
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        of_doc = (1 - y / toxic) * weight
        slope = p * of_doc[owner]
        gradient = np.append(np.bincount(at, np.repeat(slope, sizes), n), slope.sum() + base * (plain * of_doc).sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        scale = np.sqrt(second / (1 - 0.99**step)) + 1e-5
        w -= rate * (first / (1 - 0.9**step)) / scale
        if l1:  # the pull to zero acts on the scale of the step taken
            w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - rate * l1 / scale[:-1], 0)
    return w


class SentenceModel:
    def __init__(self, weights: dict[str, float]):
        self.weights, self.bias = weights, weights.get("", -30.0)
        get = weights.get
        self.of_word = WordCache(lambda w: sum([get(f, 0.0) for f in word_features(w)]))

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of every sentence with a word."""
        lowered = text.lower()
        if len(lowered) != len(text):  # a few letters change length; places then refer to the text as given
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        of_word, out = self.of_word.__getitem__, []
        for match in _sentences.finditer(lowered):
            words = set(_words.findall(match[0]))
            if words:
                z = self.bias + math.fsum(map(of_word, words))  # exact, so a set's order doesn't matter
                out.append((match.start(), match.end(), 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))))
        return out

    def score(self, sentences: list[tuple[int, int, float]]) -> float:
        clean = math.fsum(math.log1p(-min(p, 1 - 1e-12)) for _, _, p in sentences)
        return min(1.0, max(0.0, -math.expm1(clean)))


def labelled_sample(docs: DataFrame, marked: DataFrame, label: str, of_class: tuple[int, int], modulus: int, remainder: int) -> DataFrame:
    """(text, mark): about so many training documents with label 1 and with label 0, by least hashed id."""
    known = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("mark")).filter(F.col("mark").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(modulus, remainder))
    known = known.groupBy("doc_id").agg(F.max("mark").alias("mark"))
    there = {r[0]: r[1] for r in known.groupBy("mark").count().collect()}
    share = lambda mark, n: (F.col("mark") == mark) & hash_share(n / max(1, there.get(mark, 0)))
    chosen = known.filter(share(1, of_class[0]) | share(0, of_class[1]))  # bounded by of_class, so it may be sent to all
    return id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("text", "mark")


def fit_toxicity(docs: DataFrame, marked: DataFrame, sample: tuple[int, int] = SAMPLE) -> SentenceModel:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((t, m) for batch in batches for t, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        found = fit_noisy_or([t for t, _ in rows], [m for _, m in rows])
        yield record_batch(list(found.items()), arrow_schema("feature string, weight double"))

    rows = labelled_sample(docs, marked, "toxic", sample, 3, 1).repartition(1)  # the bounded sample
    return SentenceModel(dict(tuple(r) for r in rows.mapInArrow(fit, "feature string, weight double").collect()))


def score_toxicity(docs: DataFrame, model: SentenceModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, n_sentences, worst_start, worst_end, offending): offending has the starts of sentences over one half."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # the features that the bounded sample gave a weight

    def make():
        own = SentenceModel(shared.value)

        def run(batch: pa.RecordBatch) -> dict:
            found = [own.sentences(t) for t in batch.column(1).to_pylist()]
            worst = [max(s, key=lambda x: x[2], default=(None, None, 0.0)) for s in found]
            scores = [own.score(s) for s in found]
            return {
                "doc_id": batch.column(0),
                "score": scores,
                "predicted": [int(s >= threshold) for s in scores],
                "n_sentences": [len(s) for s in found],
                "worst_start": [x[0] for x in worst],
                "worst_end": [x[1] for x in worst],
                "offending": [[a for a, _, p in s if p > 0.5] for s in found],
            }

        return run

    ddl = "doc_id long, score double, predicted int, n_sentences long, worst_start long, worst_end long, offending array<long>"
    return map_rows(id_and_text(docs, id_col, text_col), make, ddl, text=1)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score_toxicity(docs, fit_toxicity(docs, labels(spark, sf_dir)))
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted", "n_sentences", "offending")


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLE_SQL: dict[str, str] = {}

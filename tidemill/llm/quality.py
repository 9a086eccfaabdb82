"""Operator 5, quality: Bradley-Terry ranking from preference pairs.

Every pair of a document marked good and one marked bad says that the first is
preferred. The score is linear in features of the whole text; logistic loss on
the features' differences fits it, over all pairs of all labelled training
rows. The threshold is the quantile of all training scores that leaves the
training share of good documents above; scores are shifted so that it lies at
0.7.

Features are computed once and staged. The fit is Newton's method, a pass over
the labelled rows each step: a pair's loss depends on two scores, so rows of a
class whose scores share a bin of ``BIN`` meet the other class together, at
their mean and variance. Sums are of whole numbers, features being read in steps of
1 / ``UNIT``, so partitions don't change the result. The driver gets one row a
class and bin, whatever the input, and the quantile comes from counts in ever
narrower ranges.

Defined results: a null text counts as empty, and an empty text is scored by
its features like any other; a very long text is read whole, and rates are by
word or line, so its length alone changes one feature; without labelled rows of
both classes every score is 0.5; null labels are not learned from; a document
labelled twice takes its best label; repeated rows score alike.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, arrow_schema, documents, held_out, id_and_text, labels, map_rows, record_batch, staged

L2 = 1e-4
#: The fit reads features in steps of 1 / UNIT; products of two, summed over two billion rows, fit 64 bits.
UNIT = 1 << 15
#: Width of the bins of scores, and how many there are on each side of the mean; the outermost are open.
BIN, REACH = 1 / 16, 1024
#: Newton's method ends when a step promises less, or after so many steps.
LEAST_GAIN, NEWTON_STEPS = 1e-9, 40
#: Ranges that the search of a quantile counts at once.
RANGES = 1000
#: Of fit_ranking.
PAIRS, STEPS, RATE = 20_000, 300, 0.05
THRESHOLD = 0.7
SEED = 5

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_OTHER = np.zeros(256, bool)
_OTHER[33:127] = True
_OTHER &= ~(_UPPER | _LOWER | _DIGIT)
_STOPS = [ord(c) for c in ".,;:'\"-()"]
_OTHER[_STOPS] = False
_ENDS = [ord(c) for c in ".!?"]
#: Two equal signs beside each other, none of them a letter, digit or white space.
_DOUBLED = re.compile(r"([^\w\s])\1")

FEATURES = ("length", "word_length", "upper", "digits", "odd_signs", "stops", "ends", "doubled_signs", "repeats", "word_variety", "line_variety", "lone_signs", "line_length", "commonest")


def features(text: str) -> list[float]:
    """Shares and rates between 0 and about 1, in the order of FEATURES."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = text.split(), text.split("\n")
    n, size = max(1, len(words)), max(1, len(data))
    upper, lower = int(counts[_UPPER].sum()), int(counts[_LOWER].sum())
    counted = Counter(words)
    full = [line for line in lines if line]
    return [
        math.log1p(len(words)) / 8,
        min(1.0, len(data) / n / 16),
        upper / max(1, upper + lower),
        int(counts[_DIGIT].sum()) / size,
        min(1.0, 8 * int(counts[_OTHER].sum()) / size),
        min(1.0, int(counts[_STOPS].sum()) / n),
        min(1.0, int(counts[_ENDS].sum()) / n),
        min(1.0, len(_DOUBLED.findall(text)) / n),
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(counted) / n if len(words) > 1 else 0.0,
        1 - len(set(full)) / max(1, len(full)),
        min(1.0, 4 * sum(times for word, times in counted.items() if not (word.isalnum() or any(map(str.isalnum, word)))) / n),
        min(1.0, len(data) / max(1, len(lines)) / 2000),
        max(counted.values(), default=0) / n,
    ]


@dataclass
class Ranking:
    mean: list[float]
    weights: list[float]
    cut: float
    scale: float

    def raw(self, values: np.ndarray) -> np.ndarray:
        # one row at a time in a fixed order, so that equal texts score alike in every batch
        return ((values - np.array(self.mean)) * np.array(self.weights)).sum(axis=1)

    def score(self, values: np.ndarray) -> np.ndarray:
        """0 to 1; 0.7 at the cut."""
        if not self.weights:
            return np.full(len(values), 0.5)
        raw = self.raw(values)
        z = (raw - self.cut) * self.scale + math.log(THRESHOLD / (1 - THRESHOLD))
        return np.where(raw >= self.cut, np.maximum(1 / (1 + np.exp(-np.clip(z, -40, 40))), THRESHOLD), 1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit_ranking(values: np.ndarray, marks: np.ndarray, good_share: float, pairs: int = PAIRS, steps: int = STEPS) -> Ranking:
    """The ranking of rows in memory, on random pairs; the cut leaves good_share above, at the rows' classes weighted to it. Tables go through fit_features."""
    if not 0 < marks.sum() < len(marks):
        return Ranking([], [], 0.0, 1.0)
    random = np.random.default_rng(SEED)
    spread = values.std(axis=0) + 1e-6
    scaled = (values - values.mean(axis=0)) / spread
    good, bad = np.flatnonzero(marks == 1), np.flatnonzero(marks == 0)
    difference = scaled[random.choice(good, pairs)] - scaled[random.choice(bad, pairs)]
    w, first, second = np.zeros(values.shape[1]), np.zeros(values.shape[1]), np.zeros(values.shape[1])
    for step in range(1, steps + 1):
        lose = 1 / (1 + np.exp(np.clip(difference @ w, -40, 40)))
        gradient = -(difference * lose[:, None]).mean(axis=0) + L2 * w
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    raw = scaled @ w
    # the quantile of the scores at the training share of bad documents
    order = np.argsort(raw)
    weight = np.where(marks == 1, good_share / len(good), (1 - good_share) / len(bad))[order]
    at = int(np.searchsorted(np.cumsum(weight), 1 - good_share - 1e-9))
    at = min(at, len(raw) - 2)
    cut = float((raw[order][at] + raw[order][at + 1]) / 2)
    mean = values.mean(axis=0)
    return Ranking(mean.tolist(), (w / spread).tolist(), cut, 4 / (raw.std() + 1e-9))


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, values): the features of every whole text."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "values": [features(t) for t in batch.column(1).to_pylist()]}

        return run

    return map_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, values array<double>", text=1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


_LEFT, _RIGHT = np.triu_indices(len(FEATURES))


@dataclass
class _Bins:
    """By bin of scores of one class: rows, the features' means, the means of their products."""

    rows: np.ndarray
    means: np.ndarray
    products: np.ndarray

    def scaled(self, mean: np.ndarray, spread: np.ndarray) -> _Bins:
        cross = self.means[:, :, None] * mean
        return _Bins(self.rows, (self.means - mean) / spread, (self.products - cross - cross.transpose(0, 2, 1) + np.outer(mean, mean)) / np.outer(spread, spread))


def _bins(train: DataFrame, mean: np.ndarray, weights: np.ndarray) -> tuple[_Bins, _Bins]:
    """The bad and the good rows of (mark, values) by bins of the score under these weights, in UNITs: one pass over all rows."""
    ddl = "bin int, sums array<long>"
    schema = arrow_schema(ddl)

    def summed(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for keys, rows in parts:
            order = np.argsort(keys, kind="stable")
            keys, starts = np.unique(keys[order], return_index=True)
            for key, sums in zip(keys.tolist(), np.add.reduceat(rows[order], starts), strict=True):
                held[key] = held[key] + sums if key in held else sums
        yield record_batch([(k, v.tolist()) for k, v in held.items()], schema)

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for k in range(0, batch.num_rows, 4096):
                    part = batch.slice(k, 4096)
                    units = np.rint(_matrix(part) * UNIT).astype(np.int64)
                    at = np.clip(np.rint(((units - mean) * weights).sum(axis=1) / BIN), -REACH, REACH).astype(np.int64)
                    keys = at + REACH + part.column(0).to_numpy().astype(np.int64) * 4 * REACH
                    yield keys, np.column_stack([np.ones(len(units), np.int64), units, units[:, _LEFT] * units[:, _RIGHT]])

        return summed(parts())

    def by_bin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summed((b.column(0).to_numpy(), b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)) for b in batches if b.num_rows)

    rows = sorted(train.mapInArrow(by_task, ddl).repartition("bin").mapInArrow(by_bin, ddl).collect())  # at most 2 * REACH + 1 a class
    out = []
    for mark in (0, 1):
        sums = np.array([r[1] for r in rows if r[0] // (4 * REACH) == mark], float).reshape(-1, 1 + len(FEATURES) + len(_LEFT))
        average = sums[:, 1:] / sums[:, :1]
        products = np.zeros((len(sums), len(FEATURES), len(FEATURES)))
        products[:, _LEFT, _RIGHT] = products[:, _RIGHT, _LEFT] = average[:, len(FEATURES) :]
        out.append(_Bins(sums[:, 0], average[:, : len(FEATURES)], products))
    return out[0], out[1]


def _loss(bad: _Bins, good: _Bins, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logistic loss of all pairs, its gradient and its second derivatives."""
    ahead = (good.means @ w)[:, None] - (bad.means @ w)[None, :]
    part = np.outer(good.rows / good.rows.sum(), bad.rows / bad.rows.sum())
    lose = 1 / (1 + np.exp(np.clip(ahead, -500, 500)))
    slope = part * lose
    bend = slope * (1 - lose)
    gradient = slope.sum(axis=0) @ bad.means - slope.sum(axis=1) @ good.means
    cross = good.means.T @ bend @ bad.means
    products = np.tensordot(bend.sum(axis=1), good.products, 1) + np.tensordot(bend.sum(axis=0), bad.products, 1)
    # rows lie beside their bin's mean: the next term of the loss there
    within = products - (good.means.T * bend.sum(axis=1)) @ good.means - (bad.means.T * bend.sum(axis=0)) @ bad.means
    loss = (part * np.logaddexp(0, -ahead)).sum() + w @ within @ w / 2 + L2 / 2 * w @ w
    return float(loss), gradient + within @ w + L2 * w, products - cross - cross.T + L2 * np.eye(len(w))


def _beside(raw: DataFrame, place: int) -> tuple[float, float]:
    """The values of raw at this place (from 1) and at the next one, in ascending order."""
    low, high = raw.agg(F.min("raw"), F.max("raw")).first()
    before = 0
    while low < high:
        part = F.least(F.floor((F.col("raw") - low) / (high - low) * RANGES), F.lit(RANGES - 1))
        counted = raw.filter(F.col("raw").between(low, high)).groupBy(part.alias("part")).agg(F.count("*"), F.min("raw"), F.max("raw"))
        for _, rows, low, high in sorted(counted.collect()):  # noqa: B007  at most RANGES
            if before + rows >= place:
                break
            before += rows
    upto, above = raw.agg(F.count(F.when(F.col("raw") <= low, 1)), F.min(F.when(F.col("raw") > low, F.col("raw")))).first()
    return low, low if upto > place else above


def fit_features(found: DataFrame, marked: DataFrame) -> Ranking:
    """The ranking of (doc_id, values) by all pairs of their labelled training rows; found is best staged."""
    known = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("mark")).filter(F.col("mark").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(4, 2))
    scratch = Scratch(found.sparkSession)
    train = staged(found.join(known.groupBy("doc_id").agg(F.max("mark").alias("mark")), "doc_id").select("mark", "values"), "quality-train", scratch)
    try:
        return _fit(train, scratch)
    finally:
        scratch.clear()


def _fit(train: DataFrame, scratch: Scratch) -> Ranking:
    n = len(FEATURES)
    w = np.zeros(n)
    bad, good = _bins(train, w, w)  # one bin a class
    if not len(bad.rows) or not len(good.rows):
        return Ranking([], [], 0.0, 1.0)
    n_bad, n_good = int(bad.rows[0]), int(good.rows[0])
    mean = (n_bad * bad.means[0] + n_good * good.means[0]) / (n_bad + n_good)
    covered = (n_bad * bad.products[0] + n_good * good.products[0]) / (n_bad + n_good) - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(covered), 0)) + 1e-6 * UNIT
    now = _loss(bad.scaled(mean, spread), good.scaled(mean, spread), w)
    for _ in range(NEWTON_STEPS):
        step = np.linalg.solve(now[2], now[1])
        if step @ now[1] < LEAST_GAIN:
            break
        for part in (1, 1 / 2, 1 / 4, 1 / 8, 1 / 16):
            moved = w - part * step
            bad, good = _bins(train, mean, moved / spread)
            then = _loss(bad.scaled(mean, spread), good.scaled(mean, spread), moved)
            if then[0] < now[0]:
                break
        else:  # what is left lies below the bins' width
            break
        w, now = moved, then
    scale = 4 / (math.sqrt(max(0.0, w @ (covered / np.outer(spread, spread)) @ w)) + 1e-9)
    ranking = Ranking((mean / UNIT).tolist(), (w / spread * UNIT).tolist(), 0.0, scale)

    def make():
        return lambda batch: {"raw": ranking.raw(_matrix(batch))}

    raw = staged(map_rows(train, make, "raw double"), "quality-raw", scratch)
    ranking.cut = sum(_beside(raw, n_bad)) / 2
    return ranking


def fit_quality(docs: DataFrame, marked: DataFrame) -> Ranking:
    return fit_features(quality_features(docs), marked)


def score_features(found: DataFrame, ranking: Ranking, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of (doc_id, values)."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            scores = ranking.score(_matrix(batch))
            return {"doc_id": batch.column(0), "score": scores, "predicted": (scores >= threshold).astype(np.int32)}

        return run

    return map_rows(found.select("doc_id", "values"), make, "doc_id long, score double, predicted int")


def score_quality(docs: DataFrame, ranking: Ranking, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every text."""
    return score_features(quality_features(docs, id_col, text_col), ranking, threshold)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = staged(quality_features(documents(spark, sf_dir)), "quality-features")
    scored = score_features(found, fit_features(found, labels(spark, sf_dir)))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


QUERIES = {"op5_quality": op5_quality}
ORACLE_SQL: dict[str, str] = {}

"""Operator 2, language identification by rank-order profiles.

A language's profile is its most frequent letter n-grams (lengths 1 to 3, words
padded with a boundary) in order of frequency. A document's own most frequent
n-grams are ranked the same way; its distance to a profile is the sum over them
of how far out of place each stands, or the most possible if the profile lacks
it. The nearest profile wins; ties go to the language that sorts first.

Profiles are counted over a bounded sample of the training rows: of each
language, about ``SAMPLE`` rows, those of least hashed id. Prediction reads whole texts.

Defined results: a null text and one without letters is ``und`` with score 0;
without any training row every text is ``und``; null languages are not learned;
very long texts are counted whole; equal texts give equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_schema, documents, held_out, id_and_text, map_rows, record_batch

#: n-grams in a profile, and of a document that are compared.
PROFILE = 300
#: Training rows of each language that profiles are counted on, about.
SAMPLE = 3000
#: Languages that there may be: a column with more values holds something else, and fitting it is an error. None is left out.
LANGUAGES = 1000
UNKNOWN = "und"
_BOUNDARY = ord("_")
_SHIFT = 21  # bits of a code point

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.bool_)
    return _letters


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of a text's n-grams; none if it has no letter.

    Letters are lower-cased, everything else is a boundary, and a run of
    boundaries is one. A code holds up to three code points.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # one boundary in front, one behind, one for each run within
    marked = np.concatenate(([_BOUNDARY], np.where(letter, points, _BOUNDARY), [_BOUNDARY]))
    inside = marked != _BOUNDARY
    keep = inside | np.concatenate(([True], inside[:-1]))
    marked, inside = marked[keep], inside[keep]
    alphabet, local = np.unique(marked, return_inverse=True)
    n = len(alphabet)
    if n**3 <= 1 << 18:
        return _few_letters(alphabet.astype(np.int64), local, inside, n)
    wide = marked.astype(np.int64)
    parts = [wide[inside], wide[:-1] << _SHIFT | wide[1:]]
    parts.append(parts[1][:-1] << _SHIFT | wide[2:])
    middle = inside[1:-1]  # a boundary inside an n-gram would join two words
    return np.unique(np.concatenate([parts[0], parts[1], parts[2][middle]]), return_counts=True)


def _few_letters(alphabet: np.ndarray, local: np.ndarray, inside: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by counting in tables, for small alphabets."""
    ones = np.bincount(local[inside], minlength=n)
    pairs = local[:-1] * n + local[1:]
    twos = np.bincount(pairs, minlength=n * n)
    threes = np.bincount((pairs[:-1] * n + local[2:])[inside[1:-1]], minlength=1)
    one, two, three = (np.flatnonzero(c) for c in (ones, twos, threes))
    codes = np.concatenate(
        [
            alphabet[one],
            alphabet[two // n] << _SHIFT | alphabet[two % n],
            (alphabet[three // (n * n)] << _SHIFT | alphabet[three // n % n]) << _SHIFT | alphabet[three % n],
        ]
    )
    return codes, np.concatenate([ones[one], twos[two], threes[three]])


def most_frequent(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The codes of the most frequent n-grams in order; of equal counts the smaller code first."""
    if len(codes) > 4 * size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:size]]


class Profiles:
    """Ranked n-grams of each language, held for vectorised distances."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.languages, self.size = sorted(profiles), size
        self.codes = np.array(sorted({c for p in profiles.values() for c in p}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.languages)), -1, np.int64)  # the last row: in no profile
        for k, language in enumerate(self.languages):
            at = np.searchsorted(self.codes, np.array(profiles[language], np.int64))
            self.ranks[at, k] = np.arange(len(at))

    def distances(self, ordered: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, ordered)
        at[at == len(self.codes)] = 0
        at[self.codes[at] != ordered] = len(self.codes)
        ranks = self.ranks[at]
        return np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(ordered))[:, None])).sum(axis=0)

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score): 1 for a text that equals the profile, 0 for one that shares nothing."""
        if not self.languages:
            return UNKNOWN, 0.0
        ordered = most_frequent(*ngrams(text), self.size)
        if not len(ordered):
            return UNKNOWN, 0.0
        distance = self.distances(ordered)
        best = int(distance.argmin())
        return self.languages[best], 1 - float(distance[best]) / (self.size * len(ordered))


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each language's n-grams in a task; its tables are written out when they grow large."""
    schema, totals = arrow_schema("lang string, code long, n long"), {}

    def flush() -> pa.RecordBatch:
        rows = [(lang, int(c), int(n)) for lang, (codes, counts) in totals.items() for c, n in zip(codes, counts, strict=True)]
        totals.clear()
        return record_batch(rows, schema)

    for batch in batches:
        by: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by.setdefault(lang, []).append(ngrams(text))
        for lang, found in by.items():
            held = [totals[lang]] if lang in totals else []
            codes, at = np.unique(np.concatenate([c for c, _ in held + found]), return_inverse=True)
            totals[lang] = codes, np.bincount(at, np.concatenate([n for _, n in held + found]), len(codes)).astype(np.int64)
        if sum(len(c) for c, _ in totals.values()) > 500_000:
            yield flush()
    if totals:
        yield flush()


def fit_profiles(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, size: int = PROFILE, languages: int = LANGUAGES) -> Profiles:
    """Profiles from rows with a language; the driver gets ``size`` n-grams of each. ValueError if there are more than so many languages."""
    rows = id_and_text(train, id_col, text_col, lang_col).toDF("doc_id", "text", "lang").filter(F.col("lang").isNotNull())
    # of each language the share of least hashed ids
    known = rows.groupBy("lang").count()
    if known.limit(languages + 1).count() > languages:
        raise ValueError(f"more than {languages} different languages: the column holds something else")
    least = F.xxhash64(F.col("doc_id").cast("string")) < F.lit(sample) / F.col("count") * 2.0**64 - 2.0**63
    chosen = rows.join(F.broadcast(known), "lang").filter((F.col("count") <= sample) | least).select("lang", "text")
    counts = chosen.mapInArrow(_count_ngrams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= size)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for lang, code, r in top.select("lang", "code", "r").collect():
        profiles.setdefault(lang, []).append((r, code))
    return Profiles({lang: [c for _, c in sorted(ranked)] for lang, ranked in profiles.items()}, size)


def predict_languages(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # languages x profile size

    def make():
        model = shared.value

        def run(batch: pa.RecordBatch) -> dict:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            return {"doc_id": batch.column(0), "lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

        return run

    return map_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, lang_pred string, score double", text=1)


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents that languages are learned from: not held out."""
    return docs.filter(~held_out(3, 1, F.col("doc_id")))


def predicted_language(text: Column, profiles: Profiles, spark: SparkSession) -> Column:
    """The predicted language as a column, for filters that keep all other columns."""
    shared = spark.sparkContext.broadcast(profiles)

    @F.pandas_udf("string")
    def predicted(texts):  # noqa: ANN001, ANN202
        model = shared.value
        return texts.map(lambda t: model.predict(t or "")[0])

    return predicted(F.coalesce(text, F.lit("")))


def has_letter(text: Column) -> Column:
    """Whether there is a letter in the text, as n-grams count letters."""

    @F.pandas_udf("boolean")
    def found(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: any(map(str.isalpha, t)))

    return found(F.coalesce(text, F.lit("")))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = predict_languages(docs, fit_profiles(training_rows(docs)))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


QUERIES = {"op2_language": op2_language}
ORACLE_SQL: dict[str, str] = {}

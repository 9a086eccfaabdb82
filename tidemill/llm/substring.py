"""Operator 6, substring deduplication with a log-structured fingerprint index.

A window is 35 consecutive words; every word under a window whose sequence
also starts anywhere else is removed.

Each window has an anchor, the run of eight words of least hash within it.
Equal windows have equal anchors, so only windows whose anchor occurs twice can
be repeated, and a text has about one anchor for every 14 words. Windows next
to each other that share an anchor form a span.

The index holds spans: each batch of documents becomes an immutable run, sorted
and bucketed by the anchor's hash, with a row for each different span of the
batch, its number and the place of one of them. A new run is merge-joined with
the runs of the past (both are bucketed, so nothing is shuffled) and that join
says which anchors recur. What recurs is verified on words, and runs are
compacted into one by the same kind of join.

A span that occurs twice is repeated whole. Where an anchor has different spans
the single windows of one representative each are compared. Every match so
found, of spans and of windows, claims that some words of one document equal
some of another; claims that continue each other are joined, both documents
give their words, and these are compared in full. If any claim is false, hashes
have met by chance, and all is done again under the next seed. So the rows
follow the number of anchors, the text compared is about that of the repeated
passages, and no group of equal passages is ever expanded or gathered.

``IncrementalDedup`` keeps the index and the texts it refers to in a folder and
cleans batch after batch against all that came before.

Defined results: null and empty texts have no words; texts of fewer words than
a window lose nothing; repeated rows remove each other's windows; words are
taken unchanged; a null doc_id is handled by its text; very long texts are
read whole.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, arrow_schema, delete, documents, fresh, id_and_text, join_hot, map_rows, record_batch, shared_dir, slices, staged
from tidemill.llm.hashing import WordHasher, mix

WINDOW, ANCHOR = 35, 8
#: Batches that a whole table is indexed in, and runs that its index keeps before it compacts them.
BATCHES, TABLE_FAN_IN = 3, 2
#: Runs that an incremental index keeps before it compacts them.
FAN_IN = 4
#: Seeds of the hashes: the next is taken if words show that hashes met by chance.
SEEDS = (61, 62, 63)
#: Passages of one document that one row asks for at most, about.
CUTS = 2048
#: Keys up to this number are sent to all tasks (8 bytes each); more are joined by a shuffle.
SEND_KEYS = 1_000_000

_word = re.compile(r"[^ \t-\r]+")
_bytes_word = re.compile(rb"[^ \t-\r]+")


class Anchored:
    """The spans of some texts, in the order of texts and places: text, start, size (in windows), hash, sign; and the windows' hashes."""

    def __init__(self, texts: list[bytes], hasher: WordHasher, window: int = WINDOW, anchor: int = ANCHOR):
        words, self.begins = hasher.words_of(texts)
        self.n_words = np.diff(self.begins)
        n = len(words) - window + 1
        of = np.repeat(np.arange(len(texts)), self.n_words)
        whole = np.flatnonzero(of[:n] == of[window - 1 :]) if n > 0 else np.empty(0, np.int64)
        if not len(whole):
            self.text = self.start = self.size = np.empty(0, np.int64)
            self.hash = self.sign = self.windows = np.empty(0, np.uint64)
            return
        runs, within = hasher.runs(words, anchor), window - anchor + 1
        place = np.concatenate([np.lib.stride_tricks.sliding_window_view(runs[a : min(n, a + 65_536) + within - 1], within).argmin(axis=1) + np.arange(a, min(n, a + 65_536)) for a in range(0, n, 65_536)])[whole]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        at, self.size = whole[first], np.diff(np.append(first, len(whole)))
        self.text, self.hash = of[at], runs[place[first]]
        self.start = at - self.begins[self.text]
        self.windows, self._at = hasher.runs(words, window, 16), at
        with np.errstate(over="ignore"):
            shape = (place[first] - at).astype(np.uint64) * np.uint64(64) + self.size.astype(np.uint64)
            # the first and the last window of a span cover all its words
            self.sign = mix(mix(self.windows[at]) * np.uint64(3) + self.windows[at + self.size - 1] + mix(shape + np.uint64(1)))

    def windows_of(self, span: int) -> np.ndarray:
        return self.windows[self._at[span] : self._at[span] + self.size[span]]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEEDS[0], batch: int | None = None) -> DataFrame:
    """(doc_id, text, key): the key names a document. It is the id; where ids are missing or shared it is a hash of id and text."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.withColumn("key", _key(F.col("doc_id"), F.col("text"), seed, batch is None and _unique(rows), batch))


def _unique(rows: DataFrame) -> bool:
    return rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty()


def _key(doc_id: Column, text: Column, seed: int, unique: bool, batch: int | None = None) -> Column:
    hashed = F.xxhash64(F.lit(seed), F.lit(batch), F.coalesce(doc_id.cast("string"), F.lit("-")), text)
    return F.coalesce(doc_id, hashed) if unique else hashed


_SPANS = "h long, sign long, key long, start int, size int"


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def spans_of(docs: DataFrame, seed: int = SEEDS[0], window: int = WINDOW) -> DataFrame:
    """(h, sign, key, start, size): a row for each span of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hasher = arrow_schema(_SPANS), WordHasher(seed, lower=False)
        for batch in batches:
            for part in slices(batch, 1):
                found = Anchored([t.encode() for t in part.column(1).to_pylist()], hasher, window)
                columns = [_signed(found.hash), _signed(found.sign), part.column(0).to_numpy(zero_copy_only=False)[found.text], found.start, found.size]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select("key", "text").mapInArrow(run, _SPANS)


_HEADS, _CLASSES = "h bigint, n bigint, kinds bigint", "h bigint, sign bigint, n bigint, at struct<key: bigint, start: int>"


class FingerprintIndex:
    """Immutable runs in a folder, a pair of tables each: heads (h, n, kinds) and spans (h, sign, n, at).

    Heads are bucketed and sorted by the anchor's hash, spans by that and the
    span's sign, so runs are merge-joined without a shuffle, and an anchor with
    very many spans doesn't fall into one bucket. ``at`` is the place (key,
    start) of one such span. ``append`` compacts the past where it has
    ``fan_in`` runs, writes a batch's run and merge-joins it with those of the
    past. The run is part of the index only after ``commit``: the list of runs
    is kept by generations, of which the last one counts, so a job that breaks
    off leaves the index as it was, and the batch can be appended again.
    """

    def __init__(self, spark: SparkSession, path: str, fan_in: int = FAN_IN, buckets: int | None = None):
        self.spark, self.path, self.fan_in = spark, path, fan_in
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.generation, self.names, self.labels, self.open = 0, [], [], None
        try:
            last = spark.read.schema("generation int, buckets int, names array<string>, labels array<string>").json(f"{path}/generations").orderBy(F.desc("generation")).first()
        except AnalysisException:  # a new index
            last = None
        if last is not None:
            self.generation, self.buckets, self.names, self.labels = last.generation, last.buckets, list(last.names), list(last.labels)

    @property
    def batches(self) -> int:
        return len(self.labels)

    def _table(self, name: str, kind: str) -> DataFrame:
        columns, by = (_HEADS, "h") if kind == "heads" else (_CLASSES, "h, sign")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_{kind} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}_{kind}'")
        return self.spark.table(f"{name}_{kind}")

    def heads(self, name: str) -> DataFrame:
        return self._table(name, "heads")

    def spans(self, name: str) -> DataFrame:
        return self._table(name, "spans")

    def _write(self, classes: DataFrame) -> str:
        name = f"tidemill_run_{uuid.uuid4().hex}"

        def write(rows: DataFrame, kind: str, *by: str) -> None:
            rows.repartition(self.buckets, *by).write.bucketBy(self.buckets, *by).sortBy(*by).option("path", f"{self.path}/{name}_{kind}").option("compression", "zstd").saveAsTable(f"{name}_{kind}")

        write(classes, "spans", "h", "sign")
        write(self.spans(name).groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")), "heads", "h")
        return name

    def _keep(self, names: list[str], labels: list[str]) -> None:
        self.generation, self.names, self.labels = self.generation + 1, names, labels
        row = self.spark.createDataFrame([(self.generation, self.buckets, names, labels)], "generation int, buckets int, names array<string>, labels array<string>")
        row.coalesce(1).write.mode("append").json(f"{self.path}/generations")

    def append(self, spans: DataFrame) -> DataFrame:
        """Writes a batch's run; returns (h, n, kinds) of those of its anchors that occur twice, in it or in it and the past.

        The frame reads the runs as they are now: stage it before the next ``append``.
        """
        if len(self.names) >= self.fan_in:
            self.compact()
        self.open = self._write(spans.groupBy("h", "sign").agg(F.count("*").alias("n"), F.min(F.struct("key", "start")).alias("at")))
        found, n, kinds = self.heads(self.open), F.col("n"), F.col("kinds")
        for k, old in enumerate(self.names):
            found = found.join(self.heads(old).toDF("h", f"n{k}", f"kinds{k}").hint("merge"), "h", "left")
            n, kinds = n + F.coalesce(f"n{k}", F.lit(0)), kinds + F.coalesce(f"kinds{k}", F.lit(0))
        return found.select("h", n.alias("n"), kinds.alias("kinds")).filter("n > 1")

    def commit(self, label: str = "") -> None:
        """Makes the run that was appended last a part of the index; label: the batch's name."""
        if self.open is not None:
            self._keep([*self.names, self.open], [*self.labels, label])
            self.open = None

    def give_up(self) -> None:
        """Deletes a run that was appended and not committed."""
        if self.open is not None:
            self._delete([self.open])
            self.open = None

    def classes(self, anchors: DataFrame) -> DataFrame:
        """(h, sign, n, at) over all runs of these anchors: a staged frame of distinct h with the number of their kinds."""
        total, found = anchors.agg(F.sum("kinds")).first()[0] or 0, None
        for name in [*self.names, *([self.open] if self.open else [])]:
            own = join_hot(self.spans(name), anchors.select("h", "kinds"), ["h"], "kinds", total).drop("kinds")
            found = own if found is None else found.unionByName(own)
        return found.groupBy("h", "sign").agg(F.sum("n").alias("n"), F.min("at").alias("at"))

    def compact(self) -> None:
        """Merges all runs into one."""
        if len(self.names) < 2:
            return
        merged, old = self.spans(self.names[0]), self.names
        for name in self.names[1:]:
            a, b = merged.alias("a"), self.spans(name).hint("merge").alias("b")
            both = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.sign") == F.col("b.sign")), "full_outer")
            one = lambda c: F.coalesce(f"a.{c}", f"b.{c}").alias(c)
            merged = both.select(one("h"), one("sign"), (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"), F.least("a.at", "b.at").alias("at"))
        self._keep([self._write(merged)], self.labels)
        self._delete(old)

    def _delete(self, names: list[str]) -> None:
        for name in names:
            for kind in ("heads", "spans"):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}_{kind}")
                delete(self.spark, f"{self.path}/{name}_{kind}")

    def drop(self) -> None:
        """Deletes the index."""
        self.give_up()
        self._delete(self.names)
        delete(self.spark, self.path)


def _of_keys(frame: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows with one of these keys (or without): the keys go to all tasks if they are few, by count."""
    few = keys.limit(SEND_KEYS + 1).count() <= SEND_KEYS
    return frame.join(F.broadcast(keys) if few else keys, "key", how)


def _windows_of_spans(texts: DataFrame, wanted: DataFrame, seed: int, window: int) -> DataFrame:
    """(h, w, key, start, sure): the windows of some spans, one of each class."""
    ddl = "h long, w long, key long, start int, sure boolean"
    listed = wanted.groupBy(F.col("at.key").alias("key")).agg(F.collect_list(F.struct(F.col("at.start").alias("start"), (F.col("n") > 1).alias("sure"))).alias("spans"))  # of one document
    rows = _of_keys(texts, listed.select("key"), "left_semi").join(listed, "key").select("key", "text", F.col("spans.start").alias("starts"), F.col("spans.sure").alias("sure"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hasher = arrow_schema(ddl), WordHasher(seed, lower=False)
        for batch in batches:
            for part in slices(batch, 1):
                found = Anchored([t.encode() for t in part.column(1).to_pylist()], hasher, window)
                where, sure = [], []
                bounds = np.searchsorted(found.text, np.arange(part.num_rows + 1))
                for k, (starts, flags) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    where.append(bounds[k] + np.searchsorted(found.start[bounds[k] : bounds[k + 1]], starts))
                    sure += flags
                spans = np.concatenate(where).astype(np.int64)
                sizes = found.size[spans]
                columns = [
                    np.repeat(_signed(found.hash[spans]), sizes),
                    _signed(np.concatenate([found.windows_of(s) for s in spans.tolist()])),
                    part.column(0).to_numpy(zero_copy_only=False)[np.repeat(found.text[spans], sizes)],
                    np.concatenate([np.arange(found.start[s], found.start[s] + found.size[s]) for s in spans.tolist()]),
                    np.repeat(np.array(sure, bool), sizes),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, ddl)


def matched(spans: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch, seed: int, window: int) -> DataFrame:
    """(key, start, size, at_key, at_start): ``size`` windows of a document and equal ones elsewhere, or themselves if they stand for others.

    spans: staged, of the documents to clean; classes: staged, of all anchors
    that recur; texts: (key, text) of all documents that classes refer to.
    """
    twice = classes.filter("n > 1").select("h", "sign", "n", F.col("at.key").alias("at_key"), F.col("at.start").alias("at_start"))
    whole = join_hot(spans, twice, ["h", "sign"], "n", twice.agg(F.sum("n")).first()[0] or 0).select("key", "start", "size", "at_key", "at_start")
    kinds = classes.groupBy("h").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    various = staged(kinds.filter("kinds > 1 and least = 1").select("h", "kinds"), "various", scratch)
    doubtful = join_hot(classes, various, ["h"], "kinds", various.agg(F.sum("kinds")).first()[0] or 0)
    doubtful = staged(doubtful.select("n", "at"), "doubtful", scratch)
    windows = staged(_windows_of_spans(texts, doubtful, seed, window), "windows", scratch)
    groups = windows.groupBy("h", "w").agg(F.count("*").alias("m"), F.min("sure").alias("sure"), F.min(F.struct("key", "start")).alias("x")).filter("m > 1 and not sure")
    groups = staged(groups.select("h", "w", "m", F.col("x.key").alias("at_key"), F.col("x.start").alias("at_start")), "groups", scratch)
    single = join_hot(windows, groups, ["h", "w"], "m", groups.agg(F.sum("m")).first()[0] or 0)
    return whole.unionByName(single.select("key", "start", F.lit(1).alias("size"), "at_key", "at_start"))


def _claims(matches: DataFrame, window: int) -> DataFrame:
    """(key, start, n, at_key, at_start): words that must be equal, from matches that continue each other in both documents."""
    apart = matches.filter((F.col("key") != F.col("at_key")) | (F.col("start") != F.col("at_start"))).withColumn("shift", F.col("start") - F.col("at_start"))
    line = Window.partitionBy("key", "at_key", "shift").orderBy("start")
    reached = F.max(F.col("start") + F.col("size") + window - 1).over(line.rowsBetween(Window.unboundedPreceding, -1))
    begun = apart.withColumn("new", (F.col("start") > F.coalesce(reached, F.lit(-1))).cast("int"))
    joined = begun.withColumn("piece", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0))).groupBy("key", "at_key", "shift", "piece")
    return joined.agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size") + window - 1).alias("end")).select("key", "start", (F.col("end") - F.col("start")).alias("n"), "at_key", (F.col("start") - F.col("shift")).alias("at_start"))


_CUT = "key long, gone array<int>, at_key long, at_start int, n int, words binary"


def covered(starts: list[int], sizes: list[int], window: int) -> list[int]:
    """Ranges (from, to, ...) of words under so many windows at each start."""
    out: list[int] = []
    for start, size in sorted(zip(starts, sizes, strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], start + size + window - 1)
        else:
            out += [start, start + size + window - 1]
    return out


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """A row (key, gone) for each row with windows to remove, and one (at_key, at_start, n, words) for each different passage asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_CUT)
        for batch in batches:
            for part in slices(batch, 1):
                removed, passages = [], {}
                for key, text, starts, sizes, at_keys, at_starts in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words, where, counts = _bytes_word.findall(text.encode()), [], []
                    for start, size, at_key, at_start in zip(starts, sizes, at_keys, at_starts, strict=True):
                        if at_start is None:
                            where.append(start)
                            counts.append(size)
                        else:
                            passages[at_key, at_start, size, b" ".join(words[start : start + size])] = None
                    if where:
                        removed.append((key, covered(where, counts, window), None, None, None, None))
                yield record_batch(removed + [(None, None, *p) for p in passages], schema)

    return rows.select("key", "text", "starts", "sizes", "at_keys", "at_starts").mapInArrow(run, _CUT)


def _verified(matches: DataFrame, texts: DataFrame, scratch: Scratch, window: int) -> DataFrame | None:
    """(key, gone): ranges of words to remove, a row a key; None if words that were matched differ."""
    claims = staged(_claims(matches, window), "claims", scratch)
    other = claims.select(F.col("at_key").alias("key"), F.col("at_start").alias("start"), F.col("n").alias("size"), "at_key", "at_start").distinct()
    asked = claims.select("key", "start", F.col("n").alias("size"), "at_key", "at_start").unionByName(other)
    per = asked.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > CUTS)  # a document that very many others are compared with
    asked = asked.join(per, "key", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("start", "size", "at_key"), F.ceil(F.col("c") / CUTS)), F.lit(0)))
    removals = matches.select("key", "start", "size", F.lit(None).cast("long").alias("at_key"), F.lit(None).cast("int").alias("at_start"), F.lit(0).cast("long").alias("part"))
    both = asked.select(*removals.columns).unionByName(removals)
    listed = both.groupBy("key", "part").agg(F.collect_list(F.struct("start", "size", "at_key", "at_start")).alias("x"))  # of one document
    listed = staged(listed.select("key", *[F.col(f"x.{c}").alias(f"{c}s") for c in ("start", "size", "at_key", "at_start")]), "asked", scratch)
    found = staged(_cut(_of_keys(texts, listed.select("key").distinct(), "left_semi").join(listed, "key"), window), "cut", scratch)
    passages = found.filter("words is not null").groupBy("at_key", "at_start", "n").agg(F.min("words").alias("a"), F.max("words").alias("b"))
    if not passages.filter("a <> b").isEmpty():
        return None
    return found.filter("gone is not null").groupBy("key").agg(F.first("gone").alias("gone"))  # equal rows share a key


def _gone(spans: DataFrame, index: FingerprintIndex, recurring: DataFrame, texts: DataFrame, scratch: Scratch, seed: int, window: int) -> DataFrame | None:
    classes = staged(index.classes(recurring), "classes", scratch)
    matches = staged(matched(spans, classes, texts, scratch, seed, window), "matches", scratch)
    gone = _verified(matches, texts, scratch, window)
    return None if gone is None else staged(gone, "gone")


def repeated_words(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, batches: int = BATCHES, seeds: tuple[int, ...] = SEEDS) -> tuple[DataFrame, Column]:
    """(key, gone), ranges of words under repeated windows of one table, and the key as an expression over its columns."""
    spark, rows = docs.sparkSession, id_and_text(docs, id_col, text_col)
    unique = _unique(rows)
    for seed in seeds:
        own = rows.withColumn("key", _key(F.col("doc_id"), F.col("text"), seed, unique))
        scratch, texts = Scratch(spark), own.select("key", "text")
        index = FingerprintIndex(spark, f"{shared_dir(spark)}/index-{uuid.uuid4().hex}", TABLE_FAN_IN)
        try:
            spans, recurring = staged(spans_of(own, seed, window), "spans", scratch), None
            for k in range(batches):
                found = staged(index.append(spans.filter(F.pmod(F.xxhash64("key"), F.lit(batches)) == k)), "recurring", scratch)
                index.commit()
                recurring = found if recurring is None else recurring.unionByName(found)
            recurring = staged(recurring.groupBy("h").agg(F.max("n").alias("n"), F.max("kinds").alias("kinds")), "recurring", scratch)
            gone = _gone(spans, index, recurring, texts, scratch, seed, window)
        finally:
            index.drop()
            scratch.clear()
        if gone is not None:
            column = lambda c, kind: F.col(f"`{c}`").cast(kind)
            return gone, _key(column(id_col, "long"), F.coalesce(column(text_col, "string"), F.lit("")), seed, unique)
    raise RuntimeError("different words met under every seed")


class IncrementalDedup:
    """Cleans batches of documents against each other and all earlier batches, over an index that stays in a folder.

    ``add`` returns the batch's rows as ``without_repeats`` does. Words that
    occur again only in a later batch stay where they came first. A batch
    within which a passage repeats loses all of its occurrences.

    A batch is part of the past once what it loses has been written, and not
    before: an ``add`` that breaks off anywhere can be done again. A batch that
    is given a name is added once: adding it again, say because its result was
    lost, returns what it lost the first time. An empty batch has an empty result.
    """

    def __init__(self, spark: SparkSession, path: str, window: int = WINDOW, fan_in: int = FAN_IN, seeds: tuple[int, ...] = SEEDS):
        self.spark, self.path, self.window, self.fan_in, self.seeds = spark, path, window, fan_in, seeds

    def _texts(self, numbers: range) -> DataFrame:
        return self.spark.read.schema("key long, text string").parquet(*[f"{self.path}/texts-{n}" for n in numbers])

    def _index(self, seed: int) -> FingerprintIndex:
        return FingerprintIndex(self.spark, f"{self.path}/index-{seed}", self.fan_in)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str | None = None) -> DataFrame:
        known = self._index(self.seeds[0]).labels
        if name and name in known:
            number = known.index(name)
            return _cleaned(keyed(docs, id_col, text_col, 0, number), self._lost(number))
        number = len(known)
        rows = keyed(docs, id_col, text_col, 0, number)
        rows.select("key", "text").write.mode("overwrite").parquet(f"{self.path}/texts-{number}")
        tried: list[FingerprintIndex] = []
        scratch = Scratch(self.spark)
        try:
            for seed in self.seeds:
                index = self._index(seed)
                tried.append(index)
                for k in range(index.batches, number):  # under a seed that wasn't needed before, the past comes first
                    index.append(spans_of(self._texts(range(k, k + 1)), seed, self.window))
                    index.commit()
                spans = staged(spans_of(self._texts(range(number, number + 1)), seed, self.window), "spans", scratch)
                gone = _gone(spans, index, staged(index.append(spans), "recurring", scratch), self._texts(range(number + 1)), scratch, seed, self.window)
                if gone is not None:
                    break
            else:
                raise RuntimeError("different words met under every seed")
            gone.write.mode("overwrite").parquet(f"{self.path}/gone-{number}")
            # the first seed's index says which batches there are; the others follow it, now or with the next batch
            for index in tried:
                index.commit(name or "")
        finally:
            for index in tried:
                index.give_up()
            scratch.clear()
        return _cleaned(rows, self._lost(number))

    def _lost(self, number: int) -> DataFrame:
        return self.spark.read.schema("key long, gone array<int>").parquet(f"{self.path}/gone-{number}")


def _left(text: str, gone: list[int] | None) -> tuple[int, int, str]:
    """(words, words removed, the others joined by one space)."""
    words = _word.findall(text)
    kept, at, removed = [], 0, 0
    for a, b in zip((gone or [])[::2], (gone or [])[1::2], strict=True):
        kept += words[at:a]
        at, removed = b, removed + b - a
    return len(words), removed, " ".join(kept + words[at:])


def _cleaned(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """(key, doc_id, text, n_words, n_removed, kept) of (doc_id, text, key)."""
    keys = gone.select("key")
    hit = _of_keys(rows, keys, "left_semi").join(gone, "key").select("key", "doc_id", "text", "gone")
    clean = _of_keys(rows, keys, "left_anti").select("key", "doc_id", "text", F.lit(None).cast("array<int>").alias("gone"))

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            found = [_left(t, g) for t, g in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            out = dict(zip(("n_words", "n_removed", "kept"), zip(*found, strict=True), strict=True)) if found else {"n_words": [], "n_removed": [], "kept": []}
            return {"key": batch.column(0), "doc_id": batch.column(1), "text": batch.column(2)} | out

        return run

    return map_rows(hit.unionByName(clean), make, "key long, doc_id long, text string, n_words long, n_removed long, kept string", 512)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, batches: int = BATCHES, seeds: tuple[int, ...] = SEEDS) -> DataFrame:
    """(key, doc_id, text, n_words, n_removed, kept): kept has the words left, joined by one space."""
    gone, key = repeated_words(docs, id_col, text_col, window, batches, seeds)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), key.alias("key"))
    return _cleaned(own, gone)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with repeated passages taken out of the text; texts that lose nothing stay as they are. Every row stays."""
    names = docs.columns
    gone, key = repeated_words(docs, id_col, text_col, window)
    key_name, gone_name = fresh(docs, "repeat_key", "repeat_gone")
    own, marks = docs.withColumn(key_name, key), gone.toDF(key_name, gone_name)
    keys = marks.select(key_name)
    few = keys.limit(SEND_KEYS + 1).count() <= SEND_KEYS
    sent = F.broadcast(keys) if few else keys

    @F.pandas_udf("string")
    def cleaned(texts, gone):  # noqa: ANN001, ANN202
        return texts.__class__([_left(t, g.tolist())[2] for t, g in zip(texts, gone, strict=True)], index=texts.index, dtype=object)

    new = [cleaned(F.col(f"`{n}`"), F.col(gone_name)).alias(n) if n == text_col else F.col(f"`{n}`") for n in names]
    hit = own.join(sent, key_name, "left_semi").join(marks, key_name).select(*new)
    return hit.unionByName(own.join(sent, key_name, "left_anti").select(*[F.col(f"`{n}`") for n in names]))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op6_substring": op6_substring}
ORACLE_SQL = {
    "op6_substring": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words FROM documents),
             w AS (SELECT r, unnest(generate_series(1, len(words) - 34)) AS i, words FROM d WHERE len(words) >= 35),
             k AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS win FROM w),
             m AS (SELECT r, i, count(*) OVER (PARTITION BY win) AS n FROM k),
             g AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(generate_series(i, i + 34)) AS p FROM m WHERE n > 1) GROUP BY r),
             p AS (SELECT r, doc_id, words, unnest(generate_series(1, len(words))) AS p FROM d),
             kept AS (SELECT d.r, coalesce(string_agg(d.words[p.p], ' ' ORDER BY p.p), '') AS kept, count(*) AS n
                      FROM d JOIN p ON p.r = d.r LEFT JOIN (SELECT r, unnest(gone) AS p FROM g) x ON x.r = p.r AND x.p = p.p WHERE x.p IS NULL GROUP BY d.r)
        SELECT d.doc_id, len(d.words)::BIGINT AS n_words, len(d.words) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)""",
}

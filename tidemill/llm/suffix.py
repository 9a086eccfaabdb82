"""Operator 13, removal of repeated byte strings by sorted suffixes.

Every byte under a 200-byte window whose bytes also start anywhere else goes;
windows lie within one document and are judged on the input.

Anchors. Sorting a suffix for every byte would move each text two hundred
times. Each window has an anchor instead, the run of 24 bytes of least hash
within it, the leftmost of equals. Equal windows have their anchors at the same
offset, so all that is compared are suffixes that begin at anchors, about one
for every 80 bytes, together with the bytes before the anchor that its windows
reach back to. Windows next to each other that share an anchor form a span. A
span whose anchor occurs once can't repeat. Spans of equal bytes (a 96-bit
BLAKE2b digest beside the anchor's hash) are counted before anything is moved,
so a passage with very many copies is one suffix with a multiplicity.

Suffix sort. Sampled splitters range-partition the anchored suffixes by their
leading tokens, three words of eight bytes; within a bucket, multikey quicksort
orders those of one anchor, a token at a time, where only runs of equal tokens
go on to the next. Neighbours' common prefixes then say which suffixes share any
given number of bytes behind the anchor; the same is done for the reversed bytes
before it. A window with o bytes before its anchor repeats if another suffix
shares 200 - o bytes behind and o bytes before.

Anchors with many different spans are divided by offset, which is part of the
order. Where there are very many, each window is a suffix of its own: sampled
splitters with a salt divide even equal suffixes among buckets, neighbours are
compared, and what lies at a bucket's edge is compared across boundaries.

Defined results: null and empty texts have no bytes; texts shorter than a
window lose nothing; repeated rows remove each other's bytes; a null doc_id is
kept and told apart by its text; very long texts are hashed in overlapping
segments and cut whole. Kept bytes are binary, since a cut may fall within a
character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, arrow_schema, documents, id_and_text, join_hot, map_rows, record_batch, slices, staged
from tidemill.llm.hashing import mix
from tidemill.llm.substring import _key, _of_keys, _unique

WINDOW, ANCHOR = 200, 24
#: Texts are hashed in segments of so many bytes.
SEGMENT = 1 << 20
#: Different spans of an anchor above which they are divided by offset, so many offsets a part; above the second number windows are sorted one by one.
PART_KINDS, PART_OFFSETS, HOT_KINDS = 512, 16, 8192
#: Suffixes that a bucket compares at once, about.
BATCH_SUFFIXES = 4000
#: Bytes of suffixes that a range should hold.
RANGE_BYTES = 32 << 20

_PLACES = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """The hashes of the runs of ANCHOR bytes at places 0 to n - 1; eight bytes at a time enter a state that is then mixed."""
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    with np.errstate(over="ignore"):
        out = mix(lanes[:n] + np.uint64(0x9E3779B97F4A7C15))
        for at in range(8, ANCHOR, 8):
            out = mix(out + lanes[at : at + n])
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: from the running minima of blocks, forwards and backwards."""
    n = len(values) - width + 1
    blocks = np.concatenate((values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], before[width - 1 : width - 1 + n])


def text_spans(text: bytes, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, size in windows, bytes from the start to the anchor, anchor's hash) of the spans of a text, a segment at a time."""
    for low in range(0, max(len(text) - window + 1, 0), SEGMENT):
        part = text[low : low + SEGMENT + window - 1]
        data = np.frombuffer(part, np.uint8)
        hashes = gram_hashes(data, len(data) - ANCHOR + 1)
        least = sliding_least((hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64), window - ANCHOR + 1)
        place = (least & _PLACES).astype(np.int64)
        start = np.flatnonzero(np.diff(place, prepend=-1))
        yield start + low, np.diff(np.append(start, len(place))), place[start] - start, hashes[place[start]]


_SPANS = "h long, s long, c int, key long, start int, size int, before int"


def spans_of(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, s, c, key, start, size, before): a row for each span of each text; s and c are a digest of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, digest = arrow_schema(_SPANS), hashlib.blake2b
        for batch in batches:
            for part in slices(batch, 1):
                columns: list[list[np.ndarray]] = [[] for _ in schema]
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    data = text.encode()
                    for start, size, before, h in text_spans(data, window):
                        ends = (start + size + (window - 1)).tolist()
                        names = np.frombuffer(b"".join([digest(data[a:b], digest_size=12).digest() for a, b in zip(start.tolist(), ends, strict=True)]), "<i4").reshape(-1, 3)
                        rows = (h.view(np.int64), np.ascontiguousarray(names[:, :2]).view("<i8").ravel(), names[:, 2], np.full(len(start), key), start, size, before)
                        for column, values in zip(columns, rows, strict=True):
                            column.append(values)
                arrays = [pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select("key", "text").mapInArrow(run, _SPANS)


def multikey_order(groups: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Rows in the order of groups, then of tokens: a token at a time, and only runs of equal ones go on to the next."""
    order = np.argsort(groups, kind="stable")
    run = np.cumsum(np.diff(groups[order], prepend=groups[order[0]]) != 0) if len(order) else order
    open_ones = np.arange(len(order))
    for depth in range(tokens.shape[1]):
        sizes = np.bincount(run[open_ones], minlength=len(order)) if len(open_ones) else open_ones
        open_ones = open_ones[sizes[run[open_ones]] > 1] if len(open_ones) else open_ones
        if not len(open_ones):
            break
        rows, runs = order[open_ones], run[open_ones]
        token = tokens[rows, depth]
        sub = np.lexsort((token, runs))
        order[open_ones], token = rows[sub], token[sub]
        new = np.concatenate(([True], (runs[1:] != runs[:-1]) | (token[1:] != token[:-1])))
        run[open_ones] = open_ones[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]  # a run is named by its first place
    return order


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join([p[:width].ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width)


def _ordered(groups: np.ndarray, parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows sorted by group and bytes, and how many bytes each shares with the row before it; -1 where the group is another."""
    table = _padded(parts, -(-width // 8) * 8)
    order = multikey_order(groups, table.view(">u8"))
    common = np.full(len(parts), -1)
    if len(parts) > 1:
        differ = table[order[1:]] != table[order[:-1]]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
        common[1:] = np.where(groups[order[1:]] == groups[order[:-1]], same, -1)
    return order, common


def repeated_windows(groups: np.ndarray, bodies: list[bytes], before: np.ndarray, size: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether each window of some suffixes equals one of another suffix of its group: a flag for each row and window.

    bodies: the bytes under a span's windows; before: those in front of its
    anchor. Rows are padded with zeros in the order, but only rows whose own
    bytes reach as far as a window does are compared by it.
    """
    n, out = len(bodies), np.zeros((len(bodies), int(size.max(initial=0))), bool)
    forward = _ordered(groups, [b[k:] for b, k in zip(bodies, before.tolist(), strict=True)], window)
    backward = _ordered(groups, [b[:k][::-1] for b, k in zip(bodies, before.tolist(), strict=True)], window - ANCHOR)

    def classes(ordered: tuple[np.ndarray, np.ndarray], least: int) -> np.ndarray:
        order, common = ordered
        named = np.empty(n, np.int64)
        named[order] = np.cumsum(common < least)
        return named

    for offset in range(int((before - size + 1).min(initial=0)), int(before.max(initial=-1)) + 1):
        rows = np.flatnonzero((before >= offset) & (before - offset < size))
        if len(rows) < 2:
            continue
        both = classes(forward, window - offset)[rows] * np.int64(n + 1) + classes(backward, offset)[rows]
        order = np.argsort(both, kind="stable")
        equal = np.flatnonzero(both[order[1:]] == both[order[:-1]])
        hit = rows[order[np.union1d(equal, equal + 1)]]
        out[hit, before[hit] - offset] = True
    return out


def _ranges(flags: np.ndarray) -> list[int]:
    """From, to, from, to, ... of the runs of true flags."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).tolist()


_SUFFIXES = "lead binary, part int, h long, s long, c int, n long, first int, before int, size int, body binary"
_GONE = "h long, s long, c int, gone array<int>"


def _suffixes(classes: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """A row for each class of spans, or for each part of its offsets: the bytes, where its anchor is, and the tokens that lead it."""
    named = F.struct("h", "s", "c", "n", "parts", F.col("at.start").alias("start"), F.col("at.size").alias("size"), F.col("at.before").alias("before"))
    listed = classes.groupBy(F.col("at.key").alias("key")).agg(F.collect_list(named).alias("x"))  # of one document
    listed = listed.select("key", *[F.col(f"x.{c}").alias(c) for c in ("h", "s", "c", "n", "parts", "start", "size", "before")])
    rows = _of_keys(texts, listed.select("key"), "left_semi").join(listed, "key").drop("key")  # repeated rows come twice; their spans repeat anyway

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SUFFIXES)
        for batch in batches:
            for part in slices(batch, 0):
                out = []
                for text, *lists in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = text.encode()
                    for h, s, c, n, parts, start, size, before in zip(*lists, strict=True):
                        lead = data[start + before : start + before + ANCHOR]
                        if not parts:
                            out.append((lead, 0, h, s, c, n, 0, before, size, data[start : start + size + window - 1]))
                            continue
                        high = before
                        while high > before - size:  # offsets from high down to low
                            low = max(high // PART_OFFSETS * PART_OFFSETS, before - size + 1)
                            first, many = before - high, high - low + 1
                            out.append((lead, 1 + high // PART_OFFSETS, h, s, c, n, first, high, many, data[start + first : start + first + many + window - 1]))
                            high = low - 1
                yield record_batch(out, schema)

    return rows.select("text", "h", "s", "c", "n", "parts", "start", "size", "before").mapInArrow(run, _SUFFIXES)


def _compare(window: int):
    """Sorted suffixes to rows (h, s, c, gone) of those of one occurrence that repeat somewhere; holds whole groups, about BATCH_SUFFIXES rows."""

    def flush(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        groups = np.cumsum([0] + [a[:2] != b[:2] for a, b in zip(rows, rows[1:], strict=False)])
        before, size = np.array([r[7] for r in rows]), np.array([r[8] for r in rows])
        flags, out = repeated_windows(groups, [r[9] for r in rows], before, size, window), []
        for k in np.flatnonzero(flags.any(axis=1)).tolist():
            _, _, h, s, c, n, first, *_ = rows[k]
            if n == 1:
                out.append((h, s, c, [first + x for x in _ranges(flags[k])]))
        return record_batch(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rows = arrow_schema(_GONE), []
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if len(rows) >= BATCH_SUFFIXES and row[:2] != rows[-1][:2]:
                        yield flush(rows, schema)
                        rows = []
                    rows.append(row)
        if rows:
            yield flush(rows, schema)

    return run


_BUCKET = "bucket int, edge binary, h long, s long, c int, w int, sure boolean"


def sorted_windows(rows: DataFrame, ranges: int, scratch: Scratch) -> DataFrame:
    """(h, s, c, w) of the rows (suffix, h, s, c, w, n) whose suffix occurs again, or whose n is over 1.

    The salt lets splitters divide equal suffixes. What is alone in its bucket
    may go on in another: a bucket's first and last suffixes are compared
    across boundaries, two a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, bucket, out = arrow_schema(_BUCKET), TaskContext.get().partitionId(), []
        last, waiting, first = None, None, True  # waiting: a row that nothing equals yet

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for suffix, h, s, c, w, n in zip(*(col.to_pylist() for col in part.columns), strict=True):
                    if suffix == last:
                        if waiting is not None:
                            out.append((bucket, None, *waiting, True))
                            waiting = None
                        out.append((bucket, None, h, s, c, w, True))
                        continue
                    if waiting is not None:  # alone, unless it is the bucket's first
                        out.append((bucket, last if first else None, *waiting, False))
                        waiting = None
                    if last is None:
                        out.append((bucket, suffix, None, None, None, None, None))
                    else:
                        first = False
                    last = suffix
                    if n > 1:
                        out.append((bucket, None, h, s, c, w, True))
                    else:
                        waiting = (h, s, c, w)
                if len(out) > 4096:
                    yield record_batch(out, schema)
                    out = []
        if last is not None:
            if waiting is not None:
                out.append((bucket, last, *waiting, False))
            out.append((bucket, last, None, None, None, None, None))
        yield record_batch(out, schema)

    salted = rows.withColumn("salt", F.xxhash64("h", "s", "c", "w"))
    ordered = salted.repartitionByRange(ranges, "suffix", "salt").sortWithinPartitions("suffix", "salt").select("suffix", "h", "s", "c", "w", "n")
    found = staged(ordered.mapInArrow(run, _BUCKET), "windows", scratch)
    across = found.filter("sure is null").select("bucket", "edge").distinct().groupBy("edge").count().filter("count > 1").select("edge")
    alone = found.filter("sure = false and edge is not null").join(across, "edge", "left_semi")
    return found.filter("sure").unionByName(alone.select(*found.columns)).select("h", "s", "c", "w")


def _windows(suffixes: DataFrame, window: int) -> DataFrame:
    """(suffix, h, s, c, w, n): the windows of suffixes, one by one."""
    ddl = "suffix binary, h long, s long, c int, w int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(ddl)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                rows = zip(*(c.to_pylist() for c in batch.slice(start, 64).columns), strict=True)
                yield record_batch([(body[k : k + window], h, s, c, first + k, n) for h, s, c, n, first, size, body in rows for k in range(size)], schema)

    return suffixes.select("h", "s", "c", "n", "first", "size", "body").mapInArrow(run, ddl)


def repeated_bytes(docs: DataFrame, window: int, scratch: Scratch, part_kinds: int = PART_KINDS, hot_kinds: int = HOT_KINDS) -> DataFrame:
    """(key, gone): ranges of bytes to remove from texts (key, text), a row a key."""
    spark, name = docs.sparkSession, ["h", "s", "c"]
    spans = staged(spans_of(docs, window), "spans", scratch)
    heads = staged(spans.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1"), "heads", scratch)
    total = heads.agg(F.sum("m")).first()[0] or 0
    recurring = staged(join_hot(spans, heads, ["h"], "m", total).drop("m"), "recurring", scratch)
    classes = recurring.groupBy(*name).agg(F.count("*").alias("n"), F.min(F.struct("key", "start", "size", "before")).alias("at"))
    classes = staged(classes, "classes", scratch)
    kinds = staged(classes.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds", scratch)
    various, rows = kinds.agg(F.sum("kinds"), F.max("kinds")).first(), None
    if various[0]:
        # of spans that occur twice all windows repeat; they are sorted with the others as these may equal a part of them
        counted = join_hot(classes, kinds, ["h"], "kinds", various[0])
        counted = counted.withColumn("parts", F.col("kinds") > part_kinds).withColumn("hot", F.col("kinds") > hot_kinds)
        bytes_of = lambda frame: frame.agg(F.sum(F.col("at.size") + window)).first()[0] or 0
        ranges = lambda n: max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // RANGE_BYTES)
        cold = counted.filter("not hot")
        suffixes = _suffixes(cold, docs, window).repartitionByRange(ranges(bytes_of(cold)), "lead", "part").sortWithinPartitions("lead", "part")
        rows = staged(suffixes.mapInArrow(_compare(window), _GONE), "compared", scratch)
        if various[1] > hot_kinds:
            hot = counted.filter("hot").withColumn("parts", F.lit(False))
            single = sorted_windows(_windows(_suffixes(hot, docs, window), window), ranges(bytes_of(hot) * window), scratch)
            rows = rows.unionByName(single.groupBy(*name).agg(F.collect_set("w").alias("ws")).select(*name, F.flatten(F.transform("ws", lambda w: F.array(w, w + 1))).alias("gone")))  # of one span
    whole = classes.filter("n > 1").select(*name, F.array(F.lit(0), F.col("at.size")).alias("gone"))
    once = whole if rows is None else whole.unionByName(rows.join(classes.filter("n = 1").select(*name), name, "left_semi"))
    found = once.join(classes.select(*name, "n"), name)
    lost = join_hot(recurring, staged(found, "repeats", scratch), name, "n", total).select("key", "start", "gone")
    return staged(lost.groupBy("key").agg(F.collect_list(F.struct("start", "gone")).alias("x")).select("key", F.col("x.start").alias("starts"), F.col("x.gone").alias("gone")), "gone")  # of one document


def cut(text: bytes, starts: list[int], gone: list[list[int]], window: int) -> tuple[bytes, int]:
    """(what is left, number of maximal runs taken out) for windows [start + a, start + b) of each pair in gone."""
    wanted = sorted((start + a, start + b - 1 + window) for start, pairs in zip(starts, gone, strict=True) for a, b in zip(pairs[::2], pairs[1::2], strict=True))
    kept, at, runs = [], 0, 0
    for low, high in wanted:
        if not runs or low > at:
            kept.append(text[at:low])
            runs += 1
        at = max(at, high)
    return b"".join([*kept, text[at:]]), runs


def without_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **kinds: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary): a row for each document. kinds: those that ``repeated_bytes`` takes."""
    rows, scratch = id_and_text(docs, id_col, text_col), Scratch(docs.sparkSession)
    own = rows.withColumn("key", _key(F.col("doc_id"), F.col("text"), 13, _unique(rows)))
    try:
        gone = repeated_bytes(own.select("key", "text"), window, scratch, **kinds)
    finally:
        scratch.clear()
    hit = _of_keys(own, gone.select("key"), "left_semi").join(gone, "key").select("doc_id", "text", "starts", "gone")
    none = _of_keys(own, gone.select("key"), "left_anti").select("doc_id", "text", F.lit(None).cast("array<int>").alias("starts"), F.lit(None).cast("array<array<int>>").alias("gone"))

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            kept, runs, sizes = [], [], []
            for text, starts, lost in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                data = text.encode()
                left, n = cut(data, starts or [], lost or [], window)
                kept.append(left)
                runs.append(n)
                sizes.append(len(data))
            return {"doc_id": batch.column(0), "n_bytes": sizes, "n_removed": [a - len(b) for a, b in zip(sizes, kept, strict=True)], "n_spans": runs, "kept": kept}

        return run

    return map_rows(hit.unionByName(none), make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", 512, text=1)


def op13_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_bytes(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op13_suffix": op13_suffix}
ORACLE_SQL: dict[str, str] = {}

"""Operator 4, sharding: Karmarkar-Karp differencing over groups of equal texts.

Groups of equal texts are indivisible. Differencing keeps partial partitions
of all shards' sums and repeatedly combines the two of largest spread,
oppositely ordered: the heaviest part of one with the lightest of the other.

At scale it works as a tree. Groups are dealt by hash into buckets of bounded
size, and each bucket differences its groups into bundles of nearly equal
bytes. While there are more bundles than one place should hold, bundles are
dealt and differenced in the same way. The driver then differences the last
bundles into the shards, together with the few groups that are large by
themselves and a bounded share of single groups, which give the last step
sizes of every kind to even out the rest. What the driver gets is bounded by
parameters, whatever the number of documents.

Groups are named by SHA-256; where a name has several rows, their texts are
compared in full, and a clash is an error.

Laws: ``bytes`` (this method), ``rows`` (equal counts) and ``key`` (doc_id and
the number of shards decide, by jump hashing: one more shard takes rows only
into itself).

Defined results: a null text has no bytes and is grouped with the empty text;
a null doc_id is hashed as the empty string and comes first in its shard;
repeated rows are rows of one group; a group heavier than a shard's part fills
a shard alone as far as the others allow; an empty table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, arrow_schema, confirm_names, documents, hash_share, id_and_text, join_hot, record_batch, staged

SHARDS = 8
#: Groups (or bundles) of a bucket, about, and the bundles that a bucket makes of them.
BUCKET_GROUPS, BUCKET_BUNDLES = 50_000, 1024
#: Bundles that the driver differences at most, and single groups that it gets besides, about.
BUNDLES, SINGLES = 16_384, 4096
#: A group is large if it has this part of all bytes or of all rows.
LARGE_PART = 1 / 2048
#: Rows that get their slots in one task, about; cells whose offsets are summed in one task.
SLOT_ROWS, CELLS = 50_000, 1000
#: Group names up to this number are sent to all tasks (32 bytes each); more are joined by a shuffle.
SEND_NAMES = 200_000


def difference(sizes: list[int], parts: int) -> list[int]:
    """The part of each size, by differencing; ties go to the item that comes first.

    A node has its sums in falling order, without the zeros at the end. Most
    steps add one item: behind all others where a part is empty, else to the
    lightest part, which then moves forward; only the rest keep a whole order.
    """
    if not sizes:
        return []
    heap: list[tuple[int, int]] = [(-s if parts > 1 else 0, k) for k, s in enumerate(sizes)]
    sums: dict[int, np.ndarray] = {}
    children: list[tuple[int, int, int | np.ndarray, int, int]] = []
    heapq.heapify(heap)

    def sums_of(node: int) -> np.ndarray:
        return sums.pop(node) if node in sums else np.array([sizes[node]], np.int64)

    while len(heap) > 1:
        (_, first), (_, second) = heapq.heappop(heap), heapq.heappop(heap)
        a, b, order = sums_of(first), sums_of(second), 0
        if len(b) == 1 and len(a) < parts and b[0] <= a[-1]:
            joined, order = np.append(a, b), -1  # in order already
        elif len(b) == 1 and len(a) == parts:
            value = a[-1] + b[0]
            order = int(np.searchsorted(-a[:-1], -value, "right"))
            joined = np.concatenate((a[:order], [value], a[order:-1]))
        else:
            whole = np.zeros(min(parts, len(a) + len(b)), np.int64)
            whole[: len(a)] = a
            whole[len(whole) - len(b) :] += b[::-1]
            order = np.argsort(-whole, kind="stable").astype(np.uint16 if parts <= 65_536 else np.int64)
            joined = whole[order]
        node = len(sizes) + len(children)
        children.append((first, second, order, len(a), len(b)))
        sums[node] = joined
        heapq.heappush(heap, (-int(joined[0] - (joined[-1] if len(joined) == parts else 0)), node))
    out = [0] * len(sizes)
    places = {heap[0][1]: np.arange(len(sums[heap[0][1]]) if heap[0][1] in sums else 1)}
    for node in range(len(sizes) + len(children) - 1, len(sizes) - 1, -1):
        here = places.pop(node)
        first, second, order, of_first, of_second = children[node - len(sizes)]
        if isinstance(order, int):
            if order < 0:
                places[first], places[second] = here[:-1], here[-1:]
            else:
                places[first], places[second] = np.concatenate((here[:order], here[order + 1 :], here[order : order + 1])), here[order : order + 1]
            continue
        inner = np.empty(len(order), np.int64)
        inner[order] = here  # where each part of the unordered join ends up
        places[first], places[second] = inner[:of_first], inner[::-1][:of_second]
    for item, place in places.items():
        out[item] = int(place[0])
    return out


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, grp): no text goes further than its own row."""
    data = F.col("text").cast("binary")
    return id_and_text(docs, id_col, text_col).select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.unhex(F.sha2(data, 256)).alias("grp"))


def _bundled(items: DataFrame, buckets: int, each: int) -> DataFrame:
    """(item, bundle, bytes) of (item, bytes): each bucket's items in ``each`` bundles."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, by = arrow_schema("item binary, bundle long, bytes long"), {}
        for batch in batches:
            for bucket, item, size in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                by.setdefault(bucket, []).append((-size, item))
        for bucket, found in by.items():
            found.sort()
            parts = difference([-s for s, _ in found], each)
            yield record_batch([(g, bucket * each + b, -s) for (s, g), b in zip(found, parts, strict=True)], schema)

    dealt = items.select(F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int").alias("bucket"), "item", "bytes").repartition(buckets, "bucket")
    return dealt.mapInArrow(bundle, "item binary, bundle long, bytes long")


def group_shards(rows: DataFrame, shards: int, scratch: Scratch, bucket_groups: int = BUCKET_GROUPS, each: int = BUCKET_BUNDLES, bundles: int = BUNDLES, singles: int = SINGLES) -> DataFrame:
    """(grp, n, shard): every group's rows and its shard by bytes."""
    spark = rows.sparkSession
    groups = staged(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups", scratch)
    count, all_bytes, all_rows = (x or 0 for x in groups.agg(F.count("*"), F.sum("bytes"), F.sum("n")).first())
    is_large = (F.col("bytes") >= all_bytes * LARGE_PART) | (F.col("n") >= all_rows * LARGE_PART)
    is_single = is_large | hash_share(singles / max(1, count), F.col("grp"))
    alone = [(bytes(r[0]), r[1]) for r in groups.filter(is_single).select("grp", "bytes").collect()]  # about singles + 2 / LARGE_PART rows
    items, levels, left = groups.filter(~is_single).select(F.col("grp").alias("item"), "bytes"), [], count - len(alone)
    while left > bundles or not levels:
        buckets = max(1, -(-left // bucket_groups))
        levels.append(staged(_bundled(items, buckets, each), "bundles", scratch))
        items = levels[-1].groupBy("bundle").agg(F.sum("bytes").alias("bytes")).select(F.col("bundle").cast("string").cast("binary").alias("item"), "bytes")
        left = min(left, buckets * each)
    last = [(int(bytes(r[0])), r[1]) for r in items.collect()]  # at most ``bundles`` rows
    sizes = sorted([(-s, 0, g) for g, s in alone] + [(-s, 1, str(b).encode()) for b, s in last])
    shard = difference([-s for s, _, _ in sizes], shards)
    of = lambda kind: [(bytearray(g), k) for (_, t, g), k in zip(sizes, shard, strict=True) if t == kind]
    placed = spark.createDataFrame(of(1), "item binary, shard int")
    for level in reversed(levels):
        inner = level.withColumn("up", F.col("bundle").cast("string").cast("binary")).join(placed.withColumnRenamed("item", "up"), "up")
        placed = inner.select("item", "shard")
    placed = placed.unionByName(spark.createDataFrame(of(0), "item binary, shard int"))
    return groups.select("grp", "n").join(placed.withColumnRenamed("item", "grp"), "grp")


def confirm_groups(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> None:
    """Compares the texts of groups (grp, n) of several rows in full."""
    rows = id_and_text(docs, id_col, text_col).select(F.col("text").cast("binary").alias("body"))
    named = rows.withColumn("grp", F.unhex(F.sha2("body", 256)))
    several = groups.filter("n > 1").select("grp")
    few = several.limit(SEND_NAMES + 1).count() <= SEND_NAMES
    confirm_names(named.join(F.broadcast(several) if few else several, "grp", "left_semi").select(F.col("grp").alias("name"), "body"))


def jump_shard(key: Column, shards: int) -> Column:
    """Jump consistent hashing of a 64-bit key, as a chain of comparisons: shard k takes a row with probability 1 / (k + 1)."""
    out = F.lit(0)
    for k in range(1, shards):
        out = F.when(F.pmod(F.xxhash64(key, F.lit(k)), F.lit(k + 1)) == k, F.lit(k)).otherwise(out)
    return out


def cell_offsets(celled: DataFrame, *by: str, block: int = CELLS) -> DataFrame:
    """(by, _cell, _before): rows of the cells before each, summed within blocks of cells and over blocks."""
    counts = celled.groupBy(*by, "_cell").agg(F.count("*").alias("_n")).withColumn("_block", F.floor(F.col("_cell") / block))
    within = Window.partitionBy(*by, "_block").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*by or [F.lit(0)]).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(*by, "_block").agg(F.sum("_n").alias("_n")).select(*by, "_block", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_above"))
    return counts.withColumn("_in", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(blocks, [*by, "_block"]).select(*by, "_cell", (F.col("_above") + F.col("_in")).alias("_before"))


def _celled(rows: DataFrame, count: int, slot_rows: int) -> DataFrame:
    return rows.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(max(1, -(-count // slot_rows)))).cast("int"))


def with_slots(rows: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Adds slot: gapless from 0 in each shard. rows: staged, with shard and doc_id. Join and ranks share one shuffle."""
    celled = _celled(rows, rows.count(), slot_rows)
    within = Window.partitionBy("shard", "_cell").orderBy("doc_id", "size", "text_crc32")
    return celled.join(cell_offsets(celled, "shard"), ["shard", "_cell"]).withColumn("slot", F.col("_before") + F.row_number().over(within) - 1).drop("_cell", "_before")


def shard_documents(docs: DataFrame, law: str = "bytes", shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", slot_rows: int = SLOT_ROWS, **tree: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard); tree: the sizes that ``group_shards`` takes."""
    rows, scratch = sized(docs, id_col, text_col), Scratch(docs.sparkSession)
    grown = F.lit(None).cast("int")
    if law == "bytes":
        rows = staged(rows, "sizes", scratch)
        groups = staged(group_shards(rows, shards, scratch, **tree), "shards", scratch)
        confirm_groups(docs, groups, id_col, text_col)
        placed = join_hot(rows, groups, ["grp"], "n", groups.agg(F.sum("n")).first()[0] or 0)
    elif law == "rows":
        celled = staged(_celled(rows, rows.count(), slot_rows), "sizes", scratch)
        within = Window.partitionBy("_cell").orderBy("doc_id", "size", "text_crc32")
        placed = celled.join(cell_offsets(celled), "_cell").withColumn("shard", F.pmod(F.col("_before") + F.row_number().over(within) - 1, F.lit(shards)).cast("int"))
    elif law == "key":
        key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        placed = rows.withColumn("shard", jump_shard(key, shards)).withColumn("_grown", jump_shard(key, shards + 1))
        grown = F.col("_grown")
    else:
        raise ValueError(f"no such law: {law}")
    names = ["doc_id", "size", "text_crc32", "grp", "shard", *(["_grown"] if law == "key" else [])]
    placed = staged(placed.select(*names), "placed")
    scratch.clear()
    out = with_slots(placed, slot_rows)
    return out.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), grown.cast("int").alias("grown_shard"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


QUERIES = {"op4_shards": op4_shards}
ORACLE_SQL: dict[str, str] = {}

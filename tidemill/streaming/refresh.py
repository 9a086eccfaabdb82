"""Structured Streaming: late rows are logged as invalidations, buckets are recomputed as they change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions.times import from_internal, internal
from tidemill.operators.rollups import Rollup, between
from tidemill.sources.store import KEY, ChunkedTable


def windowed(stream: DataFrame, time: str, width: str, delay: str, keys: list[str]) -> DataFrame:
    """Counts and sums by event-time window; rows later than the delay are dropped by the watermark."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.max("value").alias("max_value"))


def invalidations(rows: DataFrame, time: str, watermark: int, width: int) -> DataFrame:
    """(range_start, range_end): what of the materialised past the rows touch."""
    at = internal(F.col(time), "timestamp")
    return rows.filter(at < watermark).groupBy((at - F.pmod(at, F.lit(width))).alias("range_start")).agg((F.max(at) + 1).alias("range_end"))


def keep_merged(stream: DataFrame, rollup: Rollup, merges: tuple[str, ...], table: ChunkedTable, checkpoint: str) -> StreamingQuery:
    """A rollup that follows a stream without reading what went before: each micro-batch is aggregated by itself and merged into the stored buckets.

    merges: SQL that merges the rollup's aggregates, such as "sum(n) AS n" for
    a count; an average has to be stored as sum and count. Late rows are merged
    into old buckets like others, and the table's log names these for rollups
    above. The batch's number is kept in the manifest by the generation that
    holds its rows, so a batch that is delivered again changes nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if table.state().marks.get("batch", -1) >= number:
            return
        partial = rollup.of(batch)
        ends = partial.agg(F.min("bucket").alias("low"), F.max("bucket").alias("high")).first()
        if ends.low is None:
            return
        own = partial.withColumn("bucket", from_internal(F.col("bucket"), rollup.kind))
        with table.change() as work:
            touched = [c for c in work.chunk_ids() if ends.low - work.width < c <= ends.high]
            new = own
            if touched:  # chunks between the first and the last bucket; those without a row of the batch stay as they are
                hit = {r[0] for r in work.keyed(own).select(KEY).distinct().collect()}  # a row a chunk
                touched = [c for c in touched if c in hit]
                new = own.unionByName(work.of_chunks(touched).drop(KEY)).groupBy("bucket", *rollup.keys).agg(*map(F.expr, merges)) if touched else own
            work.put_chunks(new, touched)
            work._work.marks["batch"] = number

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_refreshed(stream: DataFrame, rollup: Rollup, read_parent, path: str, checkpoint: str) -> StreamingQuery:
    """For each micro-batch, recompute the buckets its rows fall in from the parent and overwrite just those."""

    def apply(batch: DataFrame, _: int) -> None:
        touched = rollup.of(batch).select("bucket").distinct()
        ends = touched.agg(F.min("bucket").alias("low"), F.max("bucket").alias("high")).first()
        if ends.low is None:
            return
        parent = read_parent()  # only the touched time reaches its scan
        fresh = rollup.of(parent.filter(between(parent, rollup, ends.low, ends.high + rollup.width))).join(touched, "bucket", "left_semi")
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

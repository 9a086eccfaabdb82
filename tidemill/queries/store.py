"""Chunked tables in a folder: snapshots, batch skipping, the stored catalogue, refresh from the log, verification as the command does it.

Each query writes the given table into chunks in the folder that driver and
executors share, and its result reads them there.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import functions as F

from tidemill.cli import Migration
from tidemill.functions.times import CHUNK, HOUR, ORIGIN, chunk_start, internal
from tidemill.operators import compression
from tidemill.queries.base import query, table
from tidemill.queries.data import _ROUND, _SIX, CHUNK_AT, CK, EV, EV_6H, _rounded, events
from tidemill.sources import statistics
from tidemill.sources.places import shared_folder
from tidemill.sources.store import KEY, ChunkedTable

_LATE = ("2024-01-08 00:00:00", "2024-01-11 00:00:00")


def _chunked(spark, rows, name: str = "events") -> ChunkedTable:
    made = ChunkedTable(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", "ts")
    made.append(rows)
    return made


@query(f"SELECT {EV} FROM events WHERE ts IS NOT NULL")
def snapshot_read(spark, sf_dir):
    """A snapshot reads what it was made from, although one chunk was replaced and others compressed or emptied since."""
    own = _chunked(spark, events(spark, sf_dir))
    before = own.snapshot()
    own.replace(events(spark, sf_dir).withColumn("value", F.lit(0.0)), CHUNK_AT)
    own.configure(["user_id"], ["ts"])
    first, *_, last = own.chunk_starts() or [0]
    own.compress_chunk(first)
    own.overwrite(events(spark, sf_dir).limit(0), last, last + 1)
    return before.read().drop(KEY)


@query(f"SELECT {EV} FROM events WHERE ts IS NOT NULL AND {CK} <> {CHUNK_AT} UNION ALL SELECT event_id, ts, user_id, event_type, value + 1, props FROM events WHERE {CK} = {CHUNK_AT}")
def store_after_changes(spark, sf_dir):
    """The present generation after chunks were replaced, compressed and decompressed."""
    rows = events(spark, sf_dir)
    own = _chunked(spark, rows)
    own.configure(["user_id"], ["ts", "event_id"])
    for chunk in own.chunk_starts():
        own.compress_chunk(chunk, 100)
    own.decompress_chunk(CHUNK_AT)
    own.replace(rows.withColumn("value", F.col("value") + 1), CHUNK_AT)
    return own.read().drop(KEY)


@query(f"SELECT {EV} FROM events WHERE user_id BETWEEN 10 AND 40 AND ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'")
def batch_skipping(spark, sf_dir):
    """Batches are chosen by segment and by least and greatest time before they are unpacked."""
    own = _chunked(spark, events(spark, sf_dir))
    own.configure(["user_id"], ["ts", "event_id"])
    for chunk in own.chunk_starts():
        own.compress_chunk(chunk, 50)
    return own.where({"user_id": (10, 40)}, 1704434400000000, 1704758400000000).drop(KEY)


@query(f"SELECT {CK} AS range_start, count(*) AS n, epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events WHERE ts IS NOT NULL GROUP BY 1")
def stored_catalogue(spark, sf_dir):
    """Rows and times by chunk as the writes observed them; no data is read again, one chunk is compressed."""
    own = _chunked(spark, events(spark, sf_dir))
    own.configure(["user_id"], ["ts", "event_id"])
    own.compress_chunk(CHUNK_AT)
    return own.chunks().select("range_start", "n", "low", "high")


_ONE = "SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS _batch, event_id, ts FROM events WHERE ts IS NOT NULL"


@query(f"SELECT _batch::BIGINT AS _batch, count(*) AS _count, epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi, string_agg(event_id, ',' ORDER BY ts, event_id) AS ids FROM ({_ONE}) GROUP BY 1")
def compress_one_segment(spark, sf_dir):
    """One segment holds all rows: it is ranked by ranges over all tasks."""
    packed = compression.compress(events(spark, sf_dir), [], ["ts", "event_id"], 1000, hot_rows=5000)
    return packed.select("_batch", "_count", internal(F.col("_min_ts"), "timestamp").alias("lo"), internal(F.col("_max_ts"), "timestamp").alias("hi"), F.array_join(F.transform("_rows", lambda r: r["event_id"].cast("string")), ",").alias("ids"))


def _migration(spark, **more) -> Migration:
    folder = f"{shared_folder(spark)}/migration-{uuid.uuid4().hex}"
    names = {"tables": [{"name": "public.events", "time": "ts", "width": CHUNK}], "queue": os.path.join(tempfile.gettempdir(), f"queue-{uuid.uuid4().hex}.json")}
    return Migration(spark, {"source": f"{folder}/s", "target": f"{folder}/t"} | names | more)


@query(f"SELECT {_ROUND} FROM ({_SIX})")
def refresh_invalidated(spark, sf_dir):
    """Rows that arrive below a rollup's watermark: only the buckets that the log names are computed again, and the rollup equals a full one."""
    six = {"name": "public.six", "of": "public.events", "width": 6 * HOUR, "keys": list(EV_6H.keys), "aggregates": list(EV_6H.aggregates)}
    own, rows = _migration(spark, rollups=[six]), events(spark, sf_dir)
    late = F.col("ts").between(F.lit(_LATE[0]).cast("timestamp_ntz"), F.lit(_LATE[1]).cast("timestamp_ntz")) & (F.col("value") > 50)
    late = F.coalesce(late, F.lit(False))
    own.target["public.events"].append(rows.filter(~late))
    end = (4102444800000000 - ORIGIN) // (6 * HOUR) * 6 * HOUR + ORIGIN
    own._refresh_one("public.six", own._beginning("public.six"), end)
    own.target["public.events"].append(rows.filter(late))
    own.refresh_invalidated("public.six")
    return _rounded(own._stored(own.target["public.six"]).select("bucket", "user_id", "n", "min_value", "max_value", "sum_id", "all_positive", "avg_value"))


def _verified(spark, sf_dir, change) -> list[tuple[int, str]]:
    """Chunks and the first word of the command's message: values are NaN for every fifth user on both sides."""
    own, rows = _migration(spark), events(spark, sf_dir).withColumn("value", F.when(F.col("user_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    own.source["public.events"].append(rows)
    own.target["public.events"].append(change(rows))
    starts = own.source["public.events"].chunk_starts()
    tasks = [{"chunk_id": str(s), "table": "public.events", "chunk": s, "filter": None, "lower": None, "upper": None, "generation": None} for s in starts]
    return [(int(c), m.split()[0]) for c, m in own._verify_table(tasks).items()] if tasks else []


@query(f"SELECT DISTINCT {CK} AS chunk, CASE WHEN {CK} = {CHUNK_AT} THEN 'differs' ELSE 'ok' END AS status FROM events WHERE ts IS NOT NULL")
def verify_command(spark, sf_dir):
    """The command's own path: NaN equals NaN, and one changed chunk differs."""
    changed = (chunk_start(F.col("ts")) == CHUNK_AT) & (F.col("user_id") % 5 == 0)
    change = lambda rows: rows.withColumn("value", F.when(changed, F.lit(1e9)).otherwise(F.col("value")))
    return spark.createDataFrame(_verified(spark, sf_dir, change), "chunk long, status string")


@query("SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS place, o_orderkey FROM orders WHERE o_orderkey IS NOT NULL")
def segment_places(spark, sf_dir):
    """Places of orders within three large segments, ranked over all tasks."""
    rows = table(spark, sf_dir, "orders").filter("o_orderkey is not null").select("o_orderstatus", "o_orderdate", "o_orderkey")
    packed = compression.compress(rows, ["o_orderstatus"], [("o_orderdate", False, True), "o_orderkey"], 200, hot_rows=2000)
    return packed.select("o_orderstatus", "_batch", F.posexplode("_rows")).select("o_orderstatus", (F.col("_batch") * 200 + F.col("pos") + 1).alias("place"), F.col("col.o_orderkey").alias("o_orderkey"))


@query(f"SELECT 'event_id' AS column_name, count(*) AS n, count(*) - count(event_id) AS nulls, min(event_id) AS least, max(event_id) AS greatest FROM events WHERE ts IS NOT NULL UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), min(user_id), max(user_id) FROM events WHERE ts IS NOT NULL")
def optimizer_statistics(spark, sf_dir):
    """What the metastore knows of a table after it was written, one chunk replaced and analysed again."""
    own, name = _chunked(spark, events(spark, sf_dir)), f"analysed_{uuid.uuid4().hex}"
    columns = ["event_id", "user_id"]
    try:
        statistics.analyze(own, name, columns)
        own.replace(events(spark, sf_dir), CHUNK_AT)
        full, out = statistics.analyze(own, name, columns)[0], []
        for column in columns:
            known = statistics.column_statistics(spark, full, column)
            out.append((column, statistics.row_count(spark, full), *(None if known[k] is None else int(known[k]) for k in ("num_nulls", "min", "max"))))
    finally:
        statistics.drop(own, name)
    return spark.createDataFrame(out, "column_name string, n long, nulls long, least long, greatest long")


@query(f"SELECT {CK} AS chunk, CASE WHEN {CK} = {CHUNK_AT} THEN 'partial' WHEN {CK} < {CHUNK_AT} THEN 'compressed' ELSE 'rows' END AS status, count(*) + CASE WHEN {CK} = {CHUNK_AT} THEN count(*) ELSE 0 END AS n FROM events WHERE ts IS NOT NULL GROUP BY {CK}")
def partial_chunks(spark, sf_dir):
    """Chunks before one are compressed, and that one too, which then gets its rows once more: it has both tiers."""
    rows = events(spark, sf_dir)
    own = _chunked(spark, rows)
    own.configure(["user_id"], ["ts", "event_id"])
    for chunk in own.chunk_starts():
        if chunk <= CHUNK_AT:
            own.compress_chunk(chunk)
    own.append(rows.filter(chunk_start(F.col("ts")) == CHUNK_AT))
    status = {(True, True): "partial", (False, True): "compressed", (True, False): "rows"}
    tiers = spark.createDataFrame([(c, status[own.tiers(c)]) for c in own.chunk_starts()], "chunk long, status string")  # a row a chunk
    return tiers.join(own.read().groupBy(F.col(KEY).alias("chunk")).agg(F.count("*").alias("n")), "chunk")

"""Scans, copies, verification, compression, rollups, validation and functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.idents import qualified, quote_ident, quote_literal, version_number
from tidemill.functions.times import CHUNK, DAY, HOUR, ORIGIN, chunk_start, from_internal, internal, month_bucket, time_bucket
from tidemill.operators import compression, validation, verification
from tidemill.operators.copying import range_delete, replace_range, upsert_arrays
from tidemill.operators.ranking import row_numbers
from tidemill.operators.rollups import Rollup, refresh
from tidemill.plans import planner
from tidemill.plans.catalog import json_records
from tidemill.queries.base import CTE, chunks, hypertables, query, rollups, table
from tidemill.sources.store import generated_series
from tidemill.streaming.refresh import invalidations

#: A chunk of events, and a range that cuts it.
CHUNK_AT = 1704326400000000 // CHUNK * CHUNK
LOW, HIGH = "2024-01-05 06:00:00", "2024-01-09 00:00:00"
EV = "event_id, ts, user_id, event_type, value, props"
CK = f"floor(epoch_us(ts) / {CHUNK}.0)::BIGINT * {CHUNK}"
INSIDE = f"({CK} = {CHUNK_AT} AND ts >= TIMESTAMP '{LOW}' AND ts < TIMESTAMP '{HIGH}')"
#: The target side: some rows are missing, some are later than the source's.
TARGET = "SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM events WHERE event_id % 97 <> 0"


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("ts is not null")


def target_events(spark, sf_dir):
    return events(spark, sf_dir).filter("event_id % 97 <> 0").withColumn("value", F.col("value") + 1)


def in_range():
    return (F.col("ts") >= F.lit(LOW).cast("timestamp_ntz")) & (F.col("ts") < F.lit(HIGH).cast("timestamp_ntz"))


def in_chunk():
    """The chunk by its key, and by bounds that reach the scan."""
    bounds = [F.lit(v).cast("timestamp_ntz") for v in ("2024-01-04 00:00:00", "2024-01-11 00:00:00")]
    return (chunk_start(F.col("ts")) == CHUNK_AT) & (F.col("ts") >= bounds[0]) & (F.col("ts") < bounds[1])


@query(f"SELECT {EV} FROM events WHERE user_id % 2 = 0 AND {INSIDE}")
def chunk_scan(spark, sf_dir):
    """The row tier of one chunk: even users."""
    return events(spark, sf_dir).filter(in_chunk() & in_range() & (F.col("user_id") % 2 == 0))


@query(f"SELECT {EV} FROM events WHERE {CK} = {CHUNK_AT}")
def chunk_scan_all_tiers(spark, sf_dir):
    """Even users are rows, odd ones compressed batches."""
    rows = events(spark, sf_dir).filter(in_chunk())
    odd = compression.compress(rows.filter("user_id % 2 <> 0"), ["user_id"], ["ts"], 100)
    return compression.all_tiers(rows.filter("user_id % 2 = 0"), odd)


@query(f"SELECT {EV} FROM events WHERE ts IS NOT NULL AND NOT coalesce({INSIDE}, false)")
def range_delete_query(spark, sf_dir):
    return range_delete(events(spark, sf_dir), in_chunk() & in_range())


@query(f"SELECT {EV} FROM ({TARGET}) WHERE ts IS NOT NULL AND {CK} <> {CHUNK_AT} UNION ALL SELECT {EV} FROM events WHERE {CK} = {CHUNK_AT}")
def copy_full_chunk(spark, sf_dir):
    return replace_range(target_events(spark, sf_dir), events(spark, sf_dir), in_chunk())


@query(f"SELECT {EV} FROM ({TARGET}) WHERE ts IS NOT NULL AND NOT {INSIDE} UNION ALL SELECT {EV} FROM events WHERE {INSIDE}")
def copy_replace_range(spark, sf_dir):
    return replace_range(target_events(spark, sf_dir), events(spark, sf_dir), in_chunk(), in_range())


_SEG = "SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) - 1) // 100 AS _batch, ts FROM events WHERE ts IS NOT NULL"


@query(f"SELECT user_id, _batch::BIGINT AS _batch, count(*) AS _count, epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM ({_SEG}) GROUP BY 1, 2")
def compress_batches(spark, sf_dir):
    packed = compression.compress(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], 100)
    return packed.select("user_id", "_batch", "_count", internal(F.col("_min_ts"), "timestamp").alias("lo"), internal(F.col("_max_ts"), "timestamp").alias("hi"))


_SEG_DESC = "SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY v DESC NULLS FIRST, event_id) - 1) // 100 AS _batch, v FROM (SELECT user_id, event_id, CASE WHEN value <= 80 THEN value END AS v FROM events)"


@query(f"SELECT user_id, _batch::BIGINT AS _batch, count(*) AS _count, min(v) AS lo, max(v) AS hi, string_agg(event_id, ',' ORDER BY v DESC NULLS FIRST, event_id) AS ids FROM ({_SEG_DESC}) GROUP BY 1, 2")
def compress_batches_descending(spark, sf_dir):
    """Batches in descending order with nulls first, and the order of the rows within them."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("value") <= 80, F.col("value")).alias("v"))
    packed = compression.compress(rows, ["user_id"], [("v", True, True), ("event_id", False, False)], 100)
    return packed.select("user_id", "_batch", "_count", F.col("_min_v").alias("lo"), F.col("_max_v").alias("hi"), F.array_join(F.transform("_rows", lambda r: r["event_id"].cast("string")), ",").alias("ids"))


@query(f"SELECT {EV} FROM events WHERE ts IS NOT NULL")
def decompress_batches(spark, sf_dir):
    rows = events(spark, sf_dir)
    return compression.decompress(compression.compress(rows, ["user_id"], ["ts", "event_id"], 100), rows.columns)


_NULLED = "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN user_id END AS u FROM events"
_RANK = "row_number() OVER (ORDER BY u {0}, event_id)"


def _four_orders(rows):
    rows = rows.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("u"))
    by = lambda desc, first: [("u", desc, first), ("event_id", False, False)]
    return row_numbers(rows, {"d_first": by(True, True), "d_last": by(True, False), "a_first": by(False, True), "a_last": by(False, False)}).drop("u")


@query(f"SELECT event_id, {_RANK.format('DESC NULLS FIRST')} AS d_first, {_RANK.format('DESC NULLS LAST')} AS d_last, {_RANK.format('ASC NULLS FIRST')} AS a_first, {_RANK.format('ASC NULLS LAST')} AS a_last FROM ({_NULLED})")
def orderby_nulls(spark, sf_dir):
    """The four orders over all events, by rank."""
    return _four_orders(table(spark, sf_dir, "events"))


def _summary_sql(rows: str, by: str) -> str:
    return f"""SELECT {by} count(*) AS total_count, min(event_id) AS min_event_id, max(event_id) AS max_event_id, epoch_us(min(ts)) AS min_ts, epoch_us(max(ts)) AS max_ts,
        min(user_id) AS min_user_id, max(user_id) AS max_user_id, min(event_type) AS min_event_type, max(event_type) AS max_event_type, min(value) AS min_value, max(value) AS max_value,
        sum(event_id)::BIGINT AS sum_event_id, sum(user_id)::BIGINT AS sum_user_id, count(event_id) AS count_event_id, count(ts) AS count_ts, count(user_id) AS count_user_id,
        count(event_type) AS count_event_type, count(value) AS count_value FROM ({rows}) {'GROUP BY ' + by.rstrip(', ') if by else ''}"""


def _plain(frame):
    """Sums as bigint and times as internal numbers, as both engines write them."""
    casts = {"min_ts": internal(F.col("min_ts"), "timestamp"), "max_ts": internal(F.col("max_ts"), "timestamp"), "sum_event_id": F.col("sum_event_id").cast("bigint"), "sum_user_id": F.col("sum_user_id").cast("bigint")}
    return frame.withColumns(casts)


@query(_summary_sql(f"SELECT {CK} AS chunk, * FROM events WHERE ts IS NOT NULL", "chunk, "))
def verify_summary(spark, sf_dir):
    rows = events(spark, sf_dir).drop("props").withColumn("chunk", chunk_start(F.col("ts")))
    return _plain(verification.summary(rows, ["chunk"]))


def _verify(spark, sf_dir, change_source=None, change_target=None):
    keyed = events(spark, sf_dir).withColumn("chunk", chunk_start(F.col("ts")))
    source = keyed if change_source is None else change_source(keyed)
    target = keyed if change_target is None else change_target(keyed)
    planned = chunks(spark, sf_dir, drop=False).filter("hypertable_id = 1").select(F.col("range_start").alias("chunk"))
    return verification.verify_chunks(source, target, planned, "chunk")


_CHUNKS = f"SELECT DISTINCT {CK} AS chunk FROM events WHERE ts IS NOT NULL"


@query(f"SELECT chunk, 'ok' AS status FROM ({_CHUNKS})")
def verify_chunks_ok(spark, sf_dir):
    return _verify(spark, sf_dir)


@query(f"SELECT chunk, CASE WHEN chunk = {CHUNK_AT} THEN 'mismatch' ELSE 'ok' END AS status FROM ({_CHUNKS})")
def verify_detect_extra_rows(spark, sf_dir):
    return _verify(spark, sf_dir, change_target=lambda t: t.unionByName(t.filter(F.col("chunk") == CHUNK_AT).orderBy("event_id").limit(1)))


@query(f"SELECT chunk, CASE WHEN chunk = {CHUNK_AT} THEN 'target_missing' ELSE 'ok' END AS status FROM ({_CHUNKS})")
def verify_missing_target(spark, sf_dir):
    return _verify(spark, sf_dir, change_target=lambda t: t.filter(F.col("chunk") != CHUNK_AT))


@query(f"SELECT chunk, CASE WHEN chunk = {CHUNK_AT} THEN 'source_missing' ELSE 'ok' END AS status FROM ({_CHUNKS})")
def verify_missing_source(spark, sf_dir):
    return _verify(spark, sf_dir, change_source=lambda s: s.filter(F.col("chunk") != CHUNK_AT))


_LISTED = """SELECT * FROM (VALUES ('min', 1, 'event_id'), ('min', 2, 'ts'), ('min', 3, 'user_id'), ('min', 4, 'event_type'), ('min', 5, 'value'), ('min', 6, 'props'),
    ('max', 7, 'event_id'), ('max', 8, 'ts'), ('max', 9, 'user_id'), ('max', 10, 'event_type'), ('max', 11, 'value'), ('max', 12, 'props'), ('sum', 13, 'event_id'), ('sum', 14, 'user_id'),
    ('count', 15, 'event_id'), ('count', 16, 'ts'), ('count', 17, 'user_id'), ('count', 18, 'event_type'), ('count', 19, 'value'), ('count', 20, 'props')) t(kind, position, column_name)"""
_FILLED = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS filled FROM events" for c in ("event_id", "ts", "user_id", "event_type", "value", "props"))


def _filled(spark, sf_dir):
    """(column_name, filled): how many values each column of the events has."""
    rows = table(spark, sf_dir, "events")
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in rows.columns])).alias("x")).select("x.*")


@query(f"SELECT * FROM ({_LISTED}) JOIN ({_FILLED}) USING (column_name)")
def build_select_list(spark, sf_dir):
    """The fingerprint's list, with how many values each of its columns has."""
    made = verification.select_list(table(spark, sf_dir, "events").schema)
    listed = spark.createDataFrame([(k, n + 1, c) for n, (k, c) in enumerate(made)], "kind string, position int, column_name string")
    return listed.join(_filled(spark, sf_dir), "column_name")


EV_6H = Rollup("ev_6h", "ts", 6 * HOUR, ("user_id",), ("count(*) AS n", "min(value) AS min_value", "max(value) AS max_value", "sum(event_id) AS sum_id", "bool_and(value > 0) AS all_positive", "avg(value) AS avg_value"))
EV_24H = Rollup("ev_24h", "bucket", DAY, ("user_id",), ("sum(n) AS n", "min(min_value) AS min_value", "max(max_value) AS max_value", "sum(sum_id) AS sum_id", "bool_and(all_positive) AS all_positive", "avg(avg_value) AS avg_value"))
_BUCKET = "floor((epoch_us(ts) - {o}) / {w}.0)::BIGINT * {w} + {o}"
_SIX = f"""SELECT {_BUCKET.format(w=6 * HOUR, o=0)} AS bucket, user_id, count(*) AS n, min(value) AS min_value, max(value) AS max_value, sum(event_id)::BIGINT AS sum_id,
    bool_and(value > 0) AS all_positive, avg(value) AS avg_value FROM events WHERE ts IS NOT NULL GROUP BY 1, 2"""
_DAYS = f"""SELECT bucket // {DAY} * {DAY} AS bucket, user_id, sum(n)::BIGINT AS n, min(min_value) AS min_value, max(max_value) AS max_value, sum(sum_id)::BIGINT AS sum_id,
    bool_and(all_positive) AS all_positive, avg(avg_value) AS avg_value FROM ({_SIX}) GROUP BY 1, 2"""
_ROUND = "bucket, user_id, n, min_value, max_value, sum_id, all_positive, round(avg_value, 6) AS avg_value"


def _rounded(frame):
    return frame.withColumn("avg_value", F.round("avg_value", 6))


def _daily(six):
    """The 24 h level reads buckets of the 6 h level, as timestamps."""
    return EV_24H.of(six.withColumn("bucket", F.timestamp_micros("bucket")))


@query(f"SELECT {_ROUND} FROM ({_SIX})")
def cagg_6h(spark, sf_dir):
    return _rounded(EV_6H.of(events(spark, sf_dir)))


@query(f"SELECT {_ROUND} FROM ({_DAYS})")
def cagg_24h_hier(spark, sf_dir):
    """An average of averages, as the hierarchy defines it, not a weighted one."""
    return _rounded(_daily(EV_6H.of(events(spark, sf_dir))))


@query(f"SELECT 'ev_6h' AS view_name, max(bucket) + {6 * HOUR} AS watermark FROM ({_SIX}) UNION ALL SELECT 'ev_24h', max(bucket) + {DAY} FROM ({_DAYS})")
def cagg_watermark(spark, sf_dir):
    six = EV_6H.of(events(spark, sf_dir))
    return EV_6H.watermark(six).select(F.lit("ev_6h").alias("view_name"), "watermark").unionByName(EV_24H.watermark(_daily(six)).select(F.lit("ev_24h").alias("view_name"), "watermark"))


_MID = 1705276800000000
#: Rollups over events and orders with their widths; the target stopped before the middle of January 2024, and at 1997 for orders.
_WIDTHS = {("public", "ev_6h"): ("events", "ts", 6 * HOUR), ("public", "ev_24h"): ("events", "ts", DAY), ("public", "ev_2d"): ("events", "ts", 2 * DAY), ("other", "ord_month"): ("orders", "o_orderdate", 30 * DAY)}
_STOPS = {"events": "2024-01-15", "orders": "1997-01-01"}


def _marks_sql(stop: bool) -> str:
    one = lambda s, v, t, c, w: f"SELECT '{s}' AS view_schema, '{v}' AS view_name, max(" + _BUCKET.replace("ts", c).format(w=w, o=ORIGIN % w) + f") + {w} AS watermark FROM {t} WHERE {c} IS NOT NULL" + (f" AND {c} < TIMESTAMP '{_STOPS[t]}'" if stop else "")
    return " UNION ALL ".join(one(s, v, *x) for (s, v), x in _WIDTHS.items())


_PLAN = f"""WITH RECURSIVE {CTE}, walk(mat_id, view_schema, view_name, lvl) AS (
        SELECT mat_id, view_schema, view_name, 0 FROM rollup_of WHERE raw_id NOT IN (SELECT mat_id FROM rollup_of)
        UNION ALL SELECT r.mat_id, r.view_schema, r.view_name, w.lvl + 1 FROM walk w JOIN rollup_of r ON r.raw_id = w.mat_id),
    s AS ({_marks_sql(False)}), t AS ({_marks_sql(True)})
    SELECT view_schema, view_name, lvl, 'timestamp' AS column_type, t.watermark AS window_start, s.watermark AS window_end,
           strftime(make_timestamp(t.watermark), '%Y-%m-%d %H:%M:%S') AS start_text, strftime(make_timestamp(s.watermark), '%Y-%m-%d %H:%M:%S') AS end_text
    FROM walk JOIN t USING (view_schema, view_name) JOIN s USING (view_schema, view_name) WHERE t.watermark < s.watermark"""


def _marks(spark, sf_dir, stop):
    out = None
    for (schema, view), (name, column, width) in _WIDTHS.items():
        rows = table(spark, sf_dir, name).filter(F.col(column).isNotNull())
        if stop:
            rows = rows.filter(F.col(column) < F.lit(_STOPS[name]).cast("timestamp_ntz"))
        mark = rows.agg((F.max(time_bucket(F.col(column), width)) + width).alias("watermark")).filter("watermark is not null")
        mark = mark.select(F.lit(schema).alias("view_schema"), F.lit(view).alias("view_name"), F.lit("timestamp").alias("column_type"), "watermark")
        out = mark if out is None else out.unionByName(mark)
    return out


@query(_PLAN)
def refresh_plan(spark, sf_dir):
    """Windows between the watermarks of a target that stopped in the middle and of the source, both from the data."""
    return planner.refresh_plan(rollups(spark), _marks(spark, sf_dir, False), _marks(spark, sf_dir, True))


@query(f"SELECT * FROM ({_PLAN}) WHERE view_name IN ('ev_24h', 'ev_2d')")
def refresh_filtered(spark, sf_dir):
    """The same for one view and, by cascading up, those built on it."""
    chosen = planner.closure(planner.seeds(hypertables(spark), rollups(spark), "^public[.]ev_24h$"), rollups(spark), True, False)
    own = rollups(spark).join(chosen.withColumnRenamed("id", "mat_id"), "mat_id", "left_semi").select("view_schema", "view_name")
    return planner.refresh_plan(rollups(spark), _marks(spark, sf_dir, False), _marks(spark, sf_dir, True)).join(own, ["view_schema", "view_name"], "left_semi")


@query(f"SELECT {_ROUND} FROM ({_SIX})")
def cagg_refresh_incremental(spark, sf_dir):
    """A rollup that stops in the middle, refreshed from there on, equals one computed in full."""
    rows = events(spark, sf_dir)
    stored = EV_6H.of(rows.filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))
    end = EV_6H.watermark(rows.select(time_bucket(F.col("ts"), EV_6H.width).alias("bucket"))).first()
    return _rounded(stored if end is None or end.watermark <= _MID else refresh(EV_6H, stored, rows, _MID, end.watermark))


@query(f"SELECT {CK} AS range_start, max(epoch_us(ts)) + 1 AS range_end FROM events WHERE ts < TIMESTAMP '2024-01-15' AND value > 50 GROUP BY 1")
def invalidation_log(spark, sf_dir):
    """What late rows (here, those of high value) touch before the watermark."""
    return invalidations(events(spark, sf_dir).filter("value > 50"), "ts", _MID, CHUNK)


def _bucketed(name: str, width: int):
    @query(f"SELECT {_BUCKET.format(w=width, o=ORIGIN % width)} AS bucket, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1")
    def run(spark, sf_dir):
        return events(spark, sf_dir).groupBy(time_bucket(F.col("ts"), width).alias("bucket")).agg(F.count("*").alias("n"))

    from tidemill.queries.base import ORACLE_SQL, QUERIES

    QUERIES[name], ORACLE_SQL[name] = QUERIES.pop("run"), ORACLE_SQL.pop("run")


_bucketed("bucket_6h", 6 * HOUR)
_bucketed("bucket_2d", 2 * DAY)


@query("SELECT time_bucket(INTERVAL 2 MONTHS, o_orderdate)::DATE AS bucket, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def bucket_2month(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderdate is not null").groupBy(month_bucket(F.col("o_orderdate"), 2).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey // 10 * 10 AS bucket, max(o_totalprice) AS max_price FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1")
def bucket_int(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderkey is not null").groupBy(time_bucket(F.col("o_orderkey"), 10, "bigint").alias("bucket")).agg(F.max("o_totalprice").alias("max_price"))


_EVENT_COLUMNS = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")]


_SIGNED = "SELECT * FROM (VALUES " + ", ".join(f"('events', {k + 1}, '{n}', '{t}')" for k, (n, t) in enumerate(_EVENT_COLUMNS)) + ") t(table_name, position, column_name, type_name)"


@query(f"SELECT * FROM ({_SIGNED}) JOIN ({_FILLED}) USING (column_name)")
def schema_signature(spark, sf_dir):
    """A table's signature, with how many values each column has."""
    return validation.signatures(spark, {"events": table(spark, sf_dir, "events")}).join(_filled(spark, sf_dir), "column_name")


@query("SELECT * FROM (VALUES ('orders', 'columns mismatch'), ('part', 'not found in target')) t(table_name, problem)")
def validate_columns(spark, sf_dir):
    names = ("events", "orders", "part", "nation")
    source = {n: table(spark, sf_dir, n) for n in names}
    target = {"events": source["events"], "orders": source["orders"].withColumn("o_totalprice", F.col("o_totalprice").cast("string")), "nation": source["nation"]}
    return validation.mismatches(validation.signatures(spark, source), validation.signatures(spark, target))


_SETTINGS = "SELECT user_id, user_id % 3 = 0 AS s, CASE WHEN user_id % 4 <> 0 THEN user_id % 3 = 0 END AS t FROM (SELECT DISTINCT user_id FROM events)"


@query(f"SELECT user_id FROM ({_SETTINGS}) WHERE s IS DISTINCT FROM t")
def compression_settings_mismatch(spark, sf_dir):
    """Settings of two sides as structs; a side without settings differs."""
    own = F.struct(F.array(F.lit("user_id")).alias("segmentby"), F.array(F.lit("ts")).alias("orderby"), F.array((F.col("user_id") % 3) == 0).alias("orderby_desc"))
    rows = table(spark, sf_dir, "events").select("user_id").distinct().withColumn("s", own).withColumn("t", F.when(F.col("user_id") % 4 != 0, own))
    return rows.filter(compression.settings_differ("s", "t")).select("user_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)")
def fk_violations(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 0")
    return validation.foreign_key_violations(table(spark, sf_dir, "orders"), parents, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT event_type, count(*) FILTER (WHERE value > 50) AS high, min(user_id) FILTER (WHERE value > 50) AS first_user FROM events GROUP BY 1")
def agg_filter(spark, sf_dir):
    high = F.col("value") > 50
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(high).alias("high"), F.min(F.when(high, F.col("user_id"))).alias("first_user"))


@query(f"WITH {CTE} SELECT {{0}} AS hypertable, count(*) AS chunks, count(*) FILTER (WHERE dropped) AS dropped_chunks, min(range_start) AS oldest FROM chunks c JOIN ht h ON h.id = c.hypertable_id GROUP BY 1".replace("{0}", "h.table_name"))
def chunk_stats(spark, sf_dir):
    joined = chunks(spark, sf_dir).join(hypertables(spark).withColumnRenamed("id", "hypertable_id"), "hypertable_id")
    return joined.groupBy(F.col("table_name").alias("hypertable")).agg(F.count("*").alias("chunks"), F.count_if("dropped").alias("dropped_chunks"), F.min("range_start").alias("oldest"))


@query("SELECT epoch_us(date_trunc('day', ts)) AS day, min(value) AS min_value, max(value) AS max_value, count(*) AS n, sum(event_id)::BIGINT AS sum_id FROM events WHERE ts IS NOT NULL GROUP BY 1")
def daily_stats(spark, sf_dir):
    day = internal(F.date_trunc("day", F.col("ts").cast("timestamp")), "timestamptz").alias("day")
    return events(spark, sf_dir).groupBy(day).agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count("*").alias("n"), F.sum("event_id").alias("sum_id"))


@query("SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part FROM orders")
def lateral_explode(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.split("o_orderpriority", "-")).alias("part"))


@query("SELECT event_id, event_type, value FROM events WHERE event_id IS NOT NULL")
def json_recordset(spark, sf_dir):
    """Events written as JSON arrays of up to a thousand, and read back as records."""
    rows = table(spark, sf_dir, "events").filter("event_id is not null")
    arrays = rows.groupBy(F.floor(F.col("event_id") / 1000).alias("part")).agg(F.to_json(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("j"))
    return json_records(arrays, "j", "event_id:bigint,event_type:string,value:double")


@query("SELECT v.name, v.mark, count(e.event_id) AS n FROM (VALUES ('a', 1), ('b', 2), ('c', 999999999)) v(name, mark) LEFT JOIN events e ON e.user_id = v.mark GROUP BY 1, 2")
def values_list(spark, sf_dir):
    listed = spark.createDataFrame([("a", 1), ("b", 2), ("c", 999999999)], "name string, mark int")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id")
    return listed.join(rows, F.col("mark") == F.col("user_id"), "left").groupBy("name", "mark").agg(F.count("event_id").alias("n"))


@query("SELECT t AS time, d::INTEGER AS device_id FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS t FROM events), generate_series(1, 3) b(d)")
def generate_series(spark, sf_dir):
    """Every hour of the events' time for three devices."""
    ends = table(spark, sf_dir, "events").agg(F.date_trunc("hour", F.min("ts")).cast("string").alias("low"), F.max("ts").cast("string").alias("high")).first()
    return generated_series(spark, ends.low, ends.high, "1 HOUR", 3)


_PLAINSQL = "CASE WHEN regexp_matches({0}, '^[a-z_][a-z0-9_$]*$') AND {0} NOT IN ('user', 'order', 'time') THEN {0} ELSE '\"' || replace({0}, '\"', '\"\"') || '\"' END"


@query(f"""SELECT name, {_PLAINSQL.format('name')} AS ident, '''' || replace(name, '''', '''''') || '''' AS literal, 'public.' || {_PLAINSQL.format('name')} AS qualified
    FROM (SELECT c_name AS name FROM customer UNION ALL SELECT 'it''s' UNION ALL SELECT 'a"b' UNION ALL SELECT 'time' UNION ALL SELECT 'user' UNION ALL SELECT 'plain_1')""")
def fn_quote_ident(spark, sf_dir):
    extra = spark.createDataFrame([("it's",), ('a"b',), ("time",), ("user",), ("plain_1",)], "name string")
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name")).unionByName(extra)
    return names.select("name", quote_ident(F.col("name")).alias("ident"), quote_literal(F.col("name")).alias("literal"), qualified(F.lit("public"), F.col("name")).alias("qualified"))


@query("SELECT event_id, epoch_us(ts) AS of_timestamp, epoch_us(ts::DATE::TIMESTAMP) AS of_date, user_id AS of_bigint, NULL::BIGINT AS of_text FROM events")
def fn_time_internal(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", internal(ts, "timestamp").alias("of_timestamp"), internal(ts.cast("date"), "date").alias("of_date"), internal(F.col("user_id"), "bigint").alias("of_bigint"), internal(F.col("event_type"), "text").alias("of_text"))


@query("SELECT event_id, ts AS as_timestamp, ts::DATE AS as_date, user_id AS as_bigint FROM events")
def fn_from_internal(spark, sf_dir):
    at = internal(F.col("ts"), "timestamp")
    return table(spark, sf_dir, "events").select("event_id", from_internal(at, "timestamp").alias("as_timestamp"), from_internal(at, "date").alias("as_date"), from_internal(F.col("user_id"), "bigint").alias("as_bigint"))


@query("""SELECT n_nationkey, '{"key":' || n_nationkey || ',"name":"' || n_name || '","none":null}' AS built, n_name AS name, 2::INTEGER AS length FROM nation""")
def fn_json_funcs(spark, sf_dir):
    built = F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("none")), {"ignoreNullFields": "false"})
    pair = F.to_json(F.array("n_nationkey", "n_regionkey"))
    return table(spark, sf_dir, "nation").select("n_nationkey", built.alias("built"), F.get_json_object(built, "$.name").alias("name"), F.json_array_length(pair).alias("length"))


@query("SELECT n_nationkey, unnest(['key', 'region']) AS k, unnest([n_nationkey, n_regionkey]) AS v FROM nation")
def fn_map_funcs(spark, sf_dir):
    made = F.map_from_arrays(F.array(F.lit("key"), F.lit("region")), F.array("n_nationkey", "n_regionkey"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(made).alias("k", "v"))


@query("SELECT o_orderkey, nullif(concat_ws(' and ', CASE WHEN o_orderkey % 2 = 0 THEN 'even' END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END), '') AS words, coalesce(nullif(o_orderstatus, 'F'), '-') AS status FROM orders")
def fn_concat_ws_nullif(spark, sf_dir):
    words = F.concat_ws(" and ", F.when(F.col("o_orderkey") % 2 == 0, F.lit("even")), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(words, F.lit("")).alias("words"), F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("F")), F.lit("-")).alias("status"))


@query("""SELECT event_type AS key, '[' || string_agg(n, ',' ORDER BY part) || ']' AS value FROM (
        SELECT event_type, 0 AS part, count(*) AS n FROM events WHERE value <= 50 GROUP BY 1 UNION ALL SELECT event_type, 1, count(*) FROM events WHERE value > 50 GROUP BY 1) GROUP BY 1""")
def telemetry_append(spark, sf_dir):
    """Arrays of events by key: new ones are appended to those that are there, other keys are added."""
    rows = table(spark, sf_dir, "events")
    counted = lambda some: some.groupBy(F.col("event_type").alias("key")).agg(F.to_json(F.array(F.count("*"))).alias("value"))
    return upsert_arrays(counted(rows.filter("value <= 50")), counted(rows.filter("value > 50")))


@query("""SELECT n_nationkey, (n_regionkey * 10000 + n_nationkey * 100)::BIGINT AS number, (n_regionkey, n_nationkey) >= (2, 14) AS recent FROM nation""")
def fn_version(spark, sf_dir):
    """Version texts as numbers, and whether they reach 2.14."""
    text = F.concat_ws(".", "n_regionkey", "n_nationkey", F.lit("0"))
    return table(spark, sf_dir, "nation").select("n_nationkey", version_number(text).alias("number"), (version_number(text) >= version_number(F.lit("2.14"))).alias("recent"))

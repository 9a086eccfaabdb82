"""Operators on their own: goldens, edge cases, the store, the queue and the commands."""

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemill.catalogue import QUERIES
from tidemill.cli import Migration, main
from tidemill.functions import idents, times
from tidemill.operators.copying import range_delete, replace_range, route, upsert_arrays
from tidemill.operators.ranking import row_numbers
from tidemill.operators.rollups import Rollup, refresh
from tidemill.operators.verification import agree, difference_report, select_list, summary
from tidemill.plans import planner
from tidemill.plans.taskqueue import TaskQueue
from tidemill.sources.store import KEY, ChunkedTable, generated_series
from tidemill.streaming.refresh import keep_refreshed
from tidemill.telemetry import Event, human_bytes, human_seconds, report

MAY = ("2023-05-01 00:00:00", "2023-05-31 23:30:00")


@pytest.fixture(scope="module")
def metrics(spark):
    return generated_series(spark, *MAY, "1 HOUR", 1).withColumn("val", F.col("device_id") * F.lit(1.5))


def _plan(spark, rows, until, frm=None):
    chunks = rows.select(times.chunk_start(F.col("time")).alias("s")).distinct().select(F.lit(1).alias("hypertable_id"), F.col("s").cast("string").alias("chunk_id"), F.col("s").alias("range_start"), (F.col("s") + times.CHUNK).alias("range_end"), F.lit(False).alias("dropped"))
    tables = spark.createDataFrame([(1, "public", "metrics")], "id int, schema_name string, table_name string")
    dims = spark.createDataFrame([(1, 1, "time", "timestamp")], "id int, hypertable_id int, column_name string, column_type string")
    return planner.plan_chunks(chunks, tables, dims, until, frm)


def test_chunk_goldens(spark, metrics):
    assert metrics.count() == 744
    assert _plan(spark, metrics, "2023-06-01").count() == 5
    one = _plan(spark, metrics, "2023-05-11", "2023-05-04").collect()
    assert len(one) == 1 and one[0]["filter"] == "\"time\" >= '2023-05-04 00:00:00'"
    assert {r["filter"] for r in _plan(spark, metrics, "2023-05-26").collect()} == {None, "\"time\" < '2023-05-26 00:00:00'"}
    assert _plan(spark, metrics, "5500").count() == 0


def test_month_and_integer_buckets(spark):
    rows = spark.createDataFrame([(dt.date(1999, 12, 31),), (dt.date(2000, 1, 1),), (dt.date(2024, 1, 6),)], "d date")
    assert [str(r[0]) for r in rows.select(times.month_bucket(F.col("d"), 2)).collect()] == ["1999-11-01", "2000-01-01", "2024-01-01"]
    numbers = spark.createDataFrame([(-1,), (0,), (30,)], "x long")
    assert [r[0] for r in numbers.select(times.time_bucket(F.col("x"), 10, "bigint")).collect()] == [-10, 0, 30]


def test_bounds(spark):
    for good in ("5500", "2016-02-01", "20160201", "2023-05-05 23:30:00"):
        planner.check_bound(spark, "until", good)
    with pytest.raises(ValueError):
        planner.check_bound(spark, "until", "whenever")
    kinds = spark.createDataFrame([("bigint",), ("timestamp",), ("text",)], "k string")
    assert [r[0] for r in kinds.select(times.parse_bound(F.lit("-5"), F.col("k"))).collect()] == [None, None, None]


def test_idents(spark):
    idents.assert_regex(spark, "^public[[:digit:]]+$")
    with pytest.raises(ValueError):
        idents.assert_regex(spark, "(")
    assert idents.java_regex("[[:alpha:]_][^[:space:]]") == r"[\p{Alpha}_][^\p{Space}]"
    assert idents.quoted_table('a"b', "c") == '"a""b"."c"'
    assert idents.prefixed("abc") == "tm_abc" and len(idents.prefixed("x" * 63)) == 63


def test_replace_range_is_idempotent_and_keeps_nulls(spark):
    target = spark.createDataFrame([(1, 10), (2, None), (3, 30), (4, 40)], "k int, v int")
    source = spark.createDataFrame([(1, 11), (3, 31), (9, 39)], "k int, v int")
    once = replace_range(target, source, F.lit(True), F.col("v").between(30, 39))
    twice = replace_range(once, source, F.lit(True), F.col("v").between(30, 39))
    wanted = [(1, 10), (2, None), (3, 31), (4, 40), (9, 39)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == wanted
    assert range_delete(target, F.col("v") > 20).count() == 2
    assert range_delete(target, None).count() == 0


@pytest.mark.parametrize(
    ("state", "steps"),
    [
        ((True, True, True, False, False), ["decompress target", "replace range from both tiers", "compress target"]),
        ((True, True, False, False, False), ["replace range from both tiers"]),
        ((False, False, True, False, True), ["decompress target", "replace range of the row tier"]),
        ((False, False, False, False, True), ["replace range of the row tier"]),
        ((False, True, True, False, True), ["write rows through the table", "append compressed batches"]),
        ((False, True, True, True, True), ["replace range of the row tier", "append compressed batches"]),
        ((False, True, False, False, True), ["replace range of the row tier", "create compressed chunk with batches"]),
    ],
)
def test_copy_routes(state, steps):
    assert route(*state) == steps


def test_row_numbers_over_ranges(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") * 7 % 11).alias("u"))
    orders = {f"n{d:d}{f:d}": [("u", d, f), ("id", False, False)] for d in (True, False) for f in (True, False)}
    numbered = row_numbers(rows, orders, 200)
    assert numbered.columns == ["id", "u", *orders]
    found, pairs = {r.id: r for r in numbered.collect()}, [tuple(r) for r in rows.collect()]
    for name, ((_, desc, first), _) in orders.items():
        key = lambda r, desc=desc, first=first: ((r[1] is None) != first, 0 if r[1] is None else -r[1] if desc else r[1], r[0])
        assert [found[i][name] for i, _ in sorted(pairs, key=key)] == list(range(1, 3001))
    assert row_numbers(rows.limit(0), orders).count() == 0


def test_orderby_nulls_ranks_all_events(spark, sf_dir):
    assert QUERIES["orderby_nulls"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_select_list_by_type(spark):
    frame = spark.sql("SELECT 1 AS i, 1.5D AS d, CAST(1.5 AS DECIMAL(5,2)) AS m, 'x' AS s, true AS b, array(1) AS a, DATE'2020-01-01' AS t, X'00' AS y")
    found = {}
    for kind, name in select_list(frame.schema):
        found.setdefault(name, set()).add(kind)
    assert found["i"] == found["m"] == {"count", "min", "max", "sum"}
    assert found["d"] == found["s"] == found["t"] == {"count", "min", "max"}
    assert found["b"] == found["a"] == found["y"] == {"count"}
    big = spark.createDataFrame([(2**62,), (2**62,), (2**62,)], "x long")
    assert summary(big).first()["sum_x"] == 3 * 2**62


def test_difference_report():
    assert difference_report({"a": 1}, {"a": 1}) == ""
    assert "-a: 1" in difference_report({"a": 1}, {"a": 2})


def test_refresh_needs_bucket_edges(spark, metrics):
    daily = Rollup("d", "time", times.DAY, ("device_id",), ("max(val) AS m",))
    stored = daily.of(metrics)
    with pytest.raises(ValueError):
        refresh(daily, stored, metrics, 5, times.DAY)
    assert daily.watermark(stored.limit(0)).count() == 0


def test_incremental_refresh_reaches_the_last_event(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    later = rows.withColumn("ts", F.expr("ts + INTERVAL 1 YEAR")).withColumn("event_id", F.col("event_id") + 1_000_000)
    for name, some in (("long", rows.unionByName(later)), ("short", rows.filter("ts < '2024-01-10'")), ("none", rows.limit(0))):
        some.write.parquet(f"{tmp_path}/{name}/events.parquet")
        full, found = (sorted(map(repr, QUERIES[q](spark, f"{tmp_path}/{name}").collect())) for q in ("cagg_6h", "cagg_refresh_incremental"))
        assert found == full


def test_store_prunes_and_replaces(spark, metrics, tmp_path):
    table = ChunkedTable(spark, str(tmp_path / "t"), "time")
    table.append(metrics)
    first = table.chunks().orderBy("range_start").first().range_start
    plan = table.read(first, first + 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and KEY in plan
    assert table.read(first, first + 1).count() == 72
    assert table.replace(metrics.withColumn("val", F.lit(0.0)), first) == 72
    assert table.read().count() == 744 and table.read().filter("val = 0").count() == 72
    assert table.replace(metrics.limit(0), first) == 0
    assert table.read().count() == 744 - 72


def test_chunks_are_listed_by_folder(spark, metrics, tmp_path):
    table = ChunkedTable(spark, str(tmp_path / "t"), "time")
    assert table.chunk_starts() == []
    old = spark.sql("SELECT TIMESTAMP_NTZ'1960-01-01' AS time, 1 AS device_id, 2.5 AS val UNION ALL SELECT NULL, 1, 3.5")
    table.append(metrics.unionByName(old))
    wanted = sorted(r.range_start for r in table.chunks().collect() if r.range_start is not None)
    assert table.chunk_starts() == wanted and wanted[0] < 0
    table.configure(["device_id"], ["time"])
    table.compress_chunk(wanted[1])
    assert table.tiers(wanted[1]) == (False, True) and table.chunk_starts() == wanted
    with pytest.raises(ValueError, match="missing in the source"):
        Migration(spark, {"source": str(tmp_path), "target": str(tmp_path / "x"), "queue": str(tmp_path / "q.json"), "tables": [{"name": "public.none", "time": "time", "width": times.CHUNK}]}).stage("2023-05-26")


def test_queue(tmp_path):
    queue = TaskQueue(str(tmp_path / "q.json"))
    plan = [{"hypertable": "a", "chunk_id": str(k)} for k in range(5)]
    assert queue.enqueue(plan[:1]) == (1, 0) and queue.enqueue(plan) == (4, 1)
    first, second = queue.claim(), queue.claim()
    assert (first["priority"], second["priority"]) == (1, 2)
    queue.give_back(first)
    queue.give_back(second)
    seen, lock = [], threading.Lock()

    def work(task):
        with lock:
            seen.append(task["chunk_id"])
        if task["chunk_id"] == "3" and seen.count("3") == 1:
            raise RuntimeError("once")
        return "done"

    with pytest.raises(RuntimeError, match="once"):
        queue.drain(work, 1)
    assert queue.count_pending() == 2
    assert TaskQueue(str(tmp_path / "q.json")).drain(work, 4) == 2
    with pytest.raises(RuntimeError, match="stage first"):
        TaskQueue(str(tmp_path / "q.json")).drain(work)
    queue.clean()
    assert TaskQueue(str(tmp_path / "q.json")).tasks == []


def test_migration_end_to_end(spark, metrics, tmp_path):
    config = {"source": str(tmp_path / "s"), "target": str(tmp_path / "t"), "queue": str(tmp_path / "q.json"), "tables": [{"name": "public.metrics", "time": "time", "width": times.CHUNK}]}
    (tmp_path / "c.json").write_text(json.dumps(config))
    ChunkedTable(spark, f"{tmp_path}/s/public.metrics", "time").append(metrics)
    june = generated_series(spark, "2023-05-20 00:00:00", "2023-06-10 00:00:00", "1 HOUR", 1).withColumn("val", F.lit(7.0))
    ChunkedTable(spark, f"{tmp_path}/t/public.metrics", "time").append(june)
    migration = Migration(spark, config)
    assert migration.stage("2023-05-26 00:00:00") == (5, 0)
    assert migration.stage("2023-05-26 00:00:00") == (0, 5)
    assert migration.copy(2) == 5
    done, failures = migration.verify(2)
    assert (done, failures) == (5, 0)
    rows = migration.target["public.metrics"].read()
    assert rows.filter("time < '2023-05-26'").count() == 600 and rows.filter("time >= '2023-05-26'").count() == 361
    with pytest.raises(ValueError):
        migration.stage("whenever")
    own = migration.session()
    assert Migration(spark, config).session() == own
    migration.clean()
    assert Migration(spark, config).session() != own


def test_bounds_in_filters_read_back(spark, metrics):
    """A bound typed as yyyyMMdd becomes one that every engine reads; integers and dates by their types."""
    plan = _plan(spark, metrics, "20230526").filter("filter is not null").first()
    assert plan["filter"] == "\"time\" < '2023-05-26 00:00:00'"
    assert metrics.filter(F.expr(plan["filter"].replace('"', "`"))).count() == 600
    kinds = spark.createDataFrame([("bigint",), ("date",), ("timestamp",), ("timestamptz",)], "k string")
    text = times.bound_text(times.parse_bound(F.lit("20230526"), F.col("k")), F.col("k"))
    assert [r[0] for r in kinds.select(text).collect()] == ["20230526", "2023-05-26", "2023-05-26 00:00:00", "2023-05-26 00:00:00+00"]
    late = times.parse_bound(F.lit("2023-05-26 13:00:00"), F.col("k"))
    assert [r[0] for r in kinds.select(times.bound_text(late, F.col("k"))).collect()][1:3] == ["2023-05-26", "2023-05-26 13:00:00"]


def test_refresh_plan_tells_schemas_apart(spark):
    rollups = spark.createDataFrame([(2, 1, "a", "day"), (3, 1, "b", "day")], "mat_id int, raw_id int, view_schema string, view_name string")
    marks = lambda *x: spark.createDataFrame([("a", "day", "timestamp", x[0]), ("b", "day", "timestamp", x[1])], "view_schema string, view_name string, column_type string, watermark long")
    found = planner.refresh_plan(rollups, marks(times.DAY, 2 * times.DAY), marks(0, 0)).collect()
    assert [(r.view_schema, r.window_end, r.end_text) for r in found] == [("a", times.DAY, "1970-01-02 00:00:00"), ("b", 2 * times.DAY, "1970-01-03 00:00:00")]


@pytest.mark.parametrize("send", [0, 100])
def test_hierarchies_are_walked_without_bounds(spark, monkeypatch, send):
    """Deeper and larger than Spark's recursion allows; nothing of the hierarchy is sent to the driver for a step, whichever way it is joined."""
    monkeypatch.setattr(planner, "SEND_LEVEL", send)
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "3")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "20")
    try:
        made = [(k, k // 2, "s", f"v{k}") for k in range(2, 40)]  # built on table 1
        rollups = spark.createDataFrame(made, "mat_id int, raw_id int, view_schema string, view_name string")
        found = planner.levels(rollups).collect()
        assert sorted((r.mat_id, r.view_name, r.lvl) for r in found) == [(k, f"v{k}", k.bit_length() - 2) for k, *_ in made]
        ids = lambda start, up, down: sorted(r.id for r in planner.closure(spark.createDataFrame([(k,) for k in start], "id int"), rollups, up, down).collect())
        assert ids([37, 19, 37], False, True) == [1, 2, 4, 9, 18, 19, 37]
        assert ids([4], True, False) == [4, 8, 9, *range(16, 20), *range(32, 40)]
        assert ids([9], True, True) == [1, 2, 4, 9, 18, 19, 36, 37, 38, 39]
        assert ids([], True, True) == [] and ids([5], False, False) == [5]
    finally:
        spark.conf.unset("spark.sql.cteRecursionLevelLimit")
        spark.conf.unset("spark.sql.cteRecursionRowLimit")


def _sent(spark, run):
    """Bytes of task results that the driver receives while run() works."""
    context, none = spark.sparkContext._jsc.sc(), spark._jvm.java.util.ArrayList()

    def stages():
        context.listenerBus().waitUntilEmpty()
        found = context.statusStore().stageList(none, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), none)
        return {s.stageId(): s.resultSize() for s in map(found.apply, range(found.size()))}

    before = stages()
    run()
    return sum(size for stage, size in stages().items() if stage not in before)


def test_what_a_walk_sends_follows_its_levels(spark, tmp_path):
    """Sixteen times the hierarchy, and the same walk down in it: the driver receives about as much."""
    wanted = {k >> s for k in range(8, 4_001, 10) for s in range(13)}
    sent = []
    for n in (4_000, 64_000):
        made, found = str(tmp_path / f"{n}"), str(tmp_path / f"{n}_found")
        spark.range(n).select(F.col("id").alias("c_custkey"), F.when(F.col("id") < 4_000, 7).otherwise(1).alias("c_nationkey")).write.parquet(f"{made}/customer.parquet")
        sent.append(_sent(spark, lambda: QUERIES["cascade_down"](spark, made).write.parquet(found)))  # noqa: B023  called at once
        assert sorted(r.id for r in spark.read.parquet(found).collect()) == sorted(wanted)
    assert 0 < sent[1] < 2 * sent[0], sent


def test_hierarchies_that_never_end(spark):
    shape = "mat_id int, raw_id int, view_schema string, view_name string"
    ring = spark.createDataFrame([(2, 3, "s", "a"), (3, 2, "s", "b"), (2, 1, "s", "c")], shape)
    assert sorted(r.id for r in planner.closure(spark.createDataFrame([(3,)], "id int"), ring, True, True).collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="cycle"):
        planner.levels(ring)
    assert planner.levels(ring.limit(0)).collect() == []


def test_refresh_filters_the_parent(spark, metrics, tmp_path):
    """The window reaches the parent's scan, for every type of time."""
    metrics.write.parquet(str(tmp_path / "m"))
    parent, daily = spark.read.parquet(str(tmp_path / "m")), Rollup("d", "time", times.DAY, ("device_id",), ("max(val) AS m",))
    stored = daily.of(metrics)
    low, high = 1683504000000000, 1683504000000000 + 2 * times.DAY
    found = refresh(daily, stored.limit(0), parent, low, high)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time," in plan and "LessThan(time," in plan
    assert sorted(map(tuple, found.collect())) == sorted(tuple(r) for r in stored.filter(F.col("bucket").between(low, high - 1)).collect())
    days = metrics.withColumn("time", F.col("time").cast("date"))
    of_days = Rollup("d", "time", 6 * times.HOUR, ("device_id",), ("count(*) AS n",), "date")
    some = refresh(of_days, of_days.of(days).limit(0), days, low + 6 * times.HOUR, high + 6 * times.HOUR)
    assert {r.bucket for r in some.collect()} == {low + times.DAY, high}


def test_compressed_chunks_are_copied(spark, metrics, tmp_path):
    """Batches go over as they are; a cut chunk is decompressed, replaced and compressed again; both tiers of a partial chunk count."""
    config = {"source": str(tmp_path / "s"), "target": str(tmp_path / "t"), "queue": str(tmp_path / "q.json"), "tables": [{"name": "public.metrics", "time": "time", "width": times.CHUNK}]}
    migration = Migration(spark, config)
    source, target = migration.source["public.metrics"], migration.target["public.metrics"]
    source.append(metrics)
    chunks = sorted(r.range_start for r in source.chunks().collect())
    with pytest.raises(ValueError, match="no compression settings"):
        source.compress_chunk(chunks[0])
    source.configure(["device_id"], [("time", True, True)])
    for chunk in chunks[:3]:
        source.compress_chunk(chunk, 50)
    assert source.tiers(chunks[0]) == (False, True) and source.read().count() == 744
    late = metrics.filter("time < '2023-05-02'").withColumn("device_id", F.lit(9))
    source.append(late)  # the first chunk is partial now
    assert source.tiers(chunks[0]) == (True, True)
    batches = source.batches(chunks[1]).select("_batch", "_rows").first()
    assert [r["time"] for r in batches._rows] == sorted((r["time"] for r in batches._rows), reverse=True)
    assert migration.stage("2023-05-13 12:00:00") == (3, 0) and migration.copy(2) == 3 and migration.verify(2) == (3, 0)
    routes = {t["range_start"]: t for t in TaskQueue(config["queue"]).tasks}
    assert set(routes) == set(chunks[:3])
    assert target.tiers(chunks[0]) == (True, True) and target.tiers(chunks[1]) == (False, True)
    both = source.read().filter("time < '2023-05-13 12:00:00'")
    content = lambda frame: sorted(map(tuple, frame.select("time", "device_id", "val").collect()))
    assert content(target.read()) == content(both)
    migration.queue.clean()
    # again, now that the target has batches: nothing is doubled, and the cut chunk is compressed again
    assert target.settings() == source.settings()
    target.compress_chunk(chunks[2])
    assert migration.stage("2023-05-13 12:00:00") == (3, 0) and migration.copy(1) == 3 and migration.verify(1) == (3, 0)
    assert content(target.read()) == content(both) and target.tiers(chunks[2]) == (False, True)
    migration.queue.clean()
    target.configure(["device_id"], ["time"])
    with pytest.raises(ValueError, match="compression settings differ"):
        migration.stage("2023-06-01")
    target.configure(["device_id"], [("time", True, True)], version=0)
    with pytest.raises(ValueError, match="format"):
        migration.stage("2023-06-01")
    migration.clean()
    assert not (tmp_path / "t" / "public.metrics_staging").exists() and not (tmp_path / "q.json").exists()


def test_sums_agree_by_tolerance(spark):
    from decimal import Decimal

    schema = spark.createDataFrame([], "x decimal(38,9), y long").schema
    row = lambda x, y=3: {"total_count": 1000, "count_x": 1000, "count_y": 1000, "sum_x": x, "sum_y": y, "min_y": 1}
    assert agree(schema, row(Decimal("1.00005")), row(Decimal("1.00015"))) and not agree(schema, row(Decimal(1)), row(Decimal(2)))
    assert agree(schema, row(None), row(None)) and not agree(schema, row(None), row(Decimal(0))) and not agree(schema, row(None, 3), row(None, 4))


def test_upsert_of_arrays(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "key string, value string")
    found = upsert_arrays(rows(("a", "[1,2]"), ("b", "[]"), ("c", "[5]")), rows(("a", "[3]"), ("b", "[4]"), ("d", "[]"), ("c", "[]")))
    assert sorted(map(tuple, found.collect())) == [("a", "[1,2,3]"), ("b", "[4]"), ("c", "[5]"), ("d", "[]")]


def test_refresh_command(spark, metrics, tmp_path, monkeypatch):
    rollups = [
        {"name": "public.six", "of": "public.metrics", "width": 6 * times.HOUR, "keys": ["device_id"], "aggregates": ["count(*) AS n"]},
        {"name": "other.day", "of": "public.six", "width": times.DAY, "keys": ["device_id"], "aggregates": ["sum(n) AS n"]},
    ]
    config = {"source": str(tmp_path / "s"), "target": str(tmp_path / "t"), "queue": str(tmp_path / "q.json"), "tables": [{"name": "public.metrics", "time": "time", "width": times.CHUNK}], "rollups": rollups}
    (tmp_path / "c.json").write_text(json.dumps(config))
    source = {**config, "target": config["source"], "watermarks": str(tmp_path / "m.json")}
    made, migration = Migration(spark, source), Migration(spark, config)
    made.source["public.metrics"].append(metrics)
    for name in ("public.six", "other.day"):
        made._refresh_one(name, made._beginning(name), 2**61 // times.DAY * times.DAY + times.ORIGIN % times.DAY)
    assert migration.stage("2023-06-01", pattern="^other[.]day$") == (5, 0)
    migration.queue.clean()
    assert migration.stage("2023-05-16", pattern="^other[.]day$", down=True) == (9, 0)
    migration.queue.clean()
    assert migration.stage("2023-05-16", pattern="metrics") == (3, 0) and migration.copy(2) == 3
    rows = lambda side, name: sorted(map(tuple, side[name].read().drop(KEY).collect()))
    # raw rows until May 16, then the rest: the second refresh goes on from the stored mark
    assert migration.refresh("six", up=True) == 2
    assert migration._saved()["other.day"] == 1684108800000000
    assert [r for r in rows(migration.source, "other.day") if r[0] < dt.datetime(2023, 5, 16)] == rows(migration.target, "other.day")
    migration.queue.clean()
    assert migration.stage("2023-06-10", "2023-05-15", pattern="metrics") == (3, 0) and migration.copy(2) == 3
    monkeypatch.setattr(SparkSession.Builder, "getOrCreate", lambda _: spark)
    assert main(["refresh", "--config", str(tmp_path / "c.json"), "--filter", "day", "--cascade-down"]) == 0
    for name in migration.rollups:
        assert rows(migration.target, name) == rows(migration.source, name)
    assert set(migration._saved()) == set(migration.rollups) and migration.refresh() == 0


def test_streamed_rollup(spark, metrics, tmp_path):
    daily = Rollup("d", "time", times.DAY, ("device_id",), ("max(val) AS m", "count(*) AS n"))
    metrics.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(metrics.schema).parquet(str(tmp_path / "in"))
    running = keep_refreshed(stream, daily, lambda: spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    running.awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out")).select("device_id", "m", "n", F.col("bucket").cast("long"))
    assert sorted(map(tuple, found.collect())) == sorted((r.device_id, r.m, r.n, r.bucket) for r in daily.of(metrics).collect())


def test_telemetry(tmp_path):
    report(Event("copy", tasks=3), str(tmp_path / "e.jsonl"))
    assert json.loads((tmp_path / "e.jsonl").read_text())["tasks"] == 3
    report(Event("copy"), "/no/such/folder/e.jsonl")
    assert human_bytes(3_100_000) == "3.1 MB" and human_seconds(75) == "1m15s"

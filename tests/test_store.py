"""Chunked tables under failures: every change counts as a whole or not at all, and can be done again."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemill.cli import Migration
from tidemill.functions import times
from tidemill.operators import compression
from tidemill.operators.ranking import numbered
from tidemill.operators.rollups import Rollup
from tidemill.plans.planner import invalidated
from tidemill.sources.manifest import ChangedMeanwhile, History, merged
from tidemill.sources.places import Files
from tidemill.sources.store import KEY, ChunkedTable, generated_series

MAY = ("2023-05-01 00:00:00", "2023-05-20 23:30:00")


@pytest.fixture(scope="module")
def metrics(spark):
    return generated_series(spark, *MAY, "1 HOUR", 2).withColumn("val", F.col("device_id") * F.lit(1.5)).cache()


def _content(table):
    return sorted(map(tuple, table.read().select("time", "device_id", "val").collect()))


def _table(spark, metrics, path):
    table = ChunkedTable(spark, str(path), "time")
    table.append(metrics)
    table.configure(["device_id"], ["time"])
    table.compress_chunk(table.chunk_starts()[1], 50)
    return table


CHANGES = {
    "compress_chunk": lambda t, m: t.compress_chunk(t.chunk_starts()[0], 50),
    "decompress_chunk": lambda t, m: t.decompress_chunk(t.chunk_starts()[1]),
    "replace": lambda t, m: t.replace(m.withColumn("val", F.lit(0.0)), t.chunk_starts()[0], F.col("device_id") == 1),
    "overwrite": lambda t, m: t.overwrite(m.withColumn("val", F.lit(7.0)).filter("time < '2023-05-12'"), t.chunk_starts()[0], t.chunk_starts()[1] + 1),
    "replace_batches": lambda t, m: t.replace_batches(t.batches(t.chunk_starts()[1]).drop(KEY), t.chunk_starts()[0]),
}


@pytest.mark.parametrize("name", list(CHANGES))
def test_a_change_that_breaks_off_leaves_nothing_and_is_done_again(spark, metrics, tmp_path, monkeypatch, name):
    """Stopped after any of its writes, and before its commit, the table holds what it held; done again, what it should."""
    change, twin = CHANGES[name], _table(spark, metrics, tmp_path / "twin")
    change(twin, metrics)
    wanted = _content(twin)
    table = _table(spark, metrics, tmp_path / "t")
    before, read_before, state = _content(table), table.read(), table.state()
    works, commits = ChunkedTable._write, History.commit
    for stop in (1, 2):
        calls = []

        def fails(self, *args, calls=calls, stop=stop, **more):
            out = works(self, *args, **more)
            calls.append(1)
            if len(calls) == stop:
                raise OSError("lost")
            return out

        monkeypatch.setattr(ChunkedTable, "_write", fails)
        if stop == 2 and name != "overwrite":
            monkeypatch.setattr(ChunkedTable, "_write", works)
            monkeypatch.setattr(History, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            change(table, metrics)
        assert _content(table) == before and table.state() == state
    monkeypatch.setattr(ChunkedTable, "_write", works)
    monkeypatch.setattr(History, "commit", commits)
    change(table, metrics)
    assert _content(table) == wanted
    if name not in ("replace_batches",):
        change(table, metrics)  # once more
        assert _content(table) == wanted
    table.clean()
    assert _content(table) == wanted
    # a frame goes on reading its own generation until that is given up
    assert sorted(map(tuple, read_before.select("time", "device_id", "val").collect())) == before
    table.vacuum()
    assert _content(table) == wanted and len(table.history.generations()) == 1


def test_generations_meet_at_the_name(spark, metrics, tmp_path):
    """Changes of different chunks follow each other; of the same chunk, the second must be done again."""
    table = _table(spark, metrics, tmp_path / "t")
    one, two = table.chunk_starts()[:2]
    with table.change() as a:
        a.replace(metrics.limit(0), one)
        table.decompress_chunk(two)
    assert not table.tiers(one)[0] and table.tiers(two) == (True, False)
    with pytest.raises(ChangedMeanwhile), table.change() as a:
        a.replace(metrics, two)
        table.replace(metrics.limit(0), two)
    assert table.tiers(two) == (False, False)
    with pytest.raises(ValueError, match="snapshot"):
        table.snapshot().append(metrics)
    with pytest.raises(ValueError, match="columns differ"):
        table.append(metrics.withColumn("more", F.lit(1)))
    files = Files(spark, str(tmp_path))
    assert files.create(f"{tmp_path}/x", "a") and not files.create(f"{tmp_path}/x", "b") and files.read(f"{tmp_path}/x") == "a"


def test_catalogue_follows_the_writes(spark, metrics, tmp_path):
    table = _table(spark, metrics, tmp_path / "t")
    kept = {r.range_start: r for r in table.chunks().collect()}
    by = table.read().groupBy(KEY).agg(F.count("*").alias("n"), F.min("time").alias("low"), F.max("time").alias("high")).collect()
    micros = lambda t: int(t.replace(tzinfo=dt.UTC).timestamp()) * 1_000_000
    assert {r[KEY]: (r.n, micros(r.low), micros(r.high)) for r in by} == {k: (r.n, r.low, r.high) for k, r in kept.items()}
    assert all(r.bytes > 0 for r in kept.values()) and [r.batches > 0 for _, r in sorted(kept.items())] == [False, True, False, False]


def test_ranges_reach_the_scan_of_batches(spark, metrics, tmp_path):
    table = ChunkedTable(spark, str(tmp_path / "t"), "time")
    table.append(metrics)
    table.configure(["device_id"], ["time"])
    for chunk in table.chunk_starts():
        table.compress_chunk(chunk, 10)
    low = table.chunk_starts()[1] + 30 * times.HOUR
    found = table.where({"device_id": (2, 2), "val": (None, 9.0)}, low, low + 25 * times.HOUR)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert all(f in pushed for f in ("GreaterThanOrEqual(_max_time", "LessThanOrEqual(_min_time", "GreaterThanOrEqual(device_id"))
    rows = [r for r in _content(table) if r[1] == 2]
    start = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=low)
    assert sorted(map(tuple, found.select("time", "device_id", "val").collect())) == [r for r in rows if start <= r[0] < start + dt.timedelta(hours=25)]
    # batches that are unpacked: those that hold such a row, and no other
    kept = table._frame("batches", table._overlapping(table.state(), low, low + 25 * times.HOUR), table.state())
    some = kept.filter(compression.skipping({"device_id": (2, 2), "time": (F.lit(start).cast("timestamp_ntz"), F.lit(start + dt.timedelta(hours=25)).cast("timestamp_ntz"))}, kept, ["device_id"])).count()
    assert 3 <= some <= 4 < kept.count()


def test_a_large_segment_is_ranked_by_ranges(spark, metrics):
    """Ties, nulls and all orders give the batches of a window; ranges are spread over tasks."""
    rows = metrics.withColumn("x", F.when(F.hour("time") % 5 != 0, F.hour("time"))).withColumn("device_id", F.when(F.col("device_id") == 1, 1))
    for order in ([("x", True, True), ("time", False, False)], [("x", False, False), ("time", True, True)]):
        shown = lambda **more: sorted(((r.device_id, r._batch, r._count, r._min_x, r._max_x, tuple(r._rows)) for r in compression.compress(rows, ["device_id"], order, 30, **more).collect()), key=repr)  # noqa: B023, E731
        assert shown(hot_rows=50) == shown()
    made = numbered(rows, [("device_id", False, True), ("time", False, False)], "n", 6)
    assert sorted(r.n for r in made.collect()) == list(range(1, rows.count() + 1))


def test_touched_buckets_below_the_watermark():
    six = Rollup("s", "time", 6 * times.HOUR, (), ("count(*) AS n",))
    shift, hour = times.ORIGIN % (6 * times.HOUR), times.HOUR
    at = lambda h: shift + h * hour
    assert merged([(5, 7), (1, 3), (3, 4), (9, 9)]) == [(1, 4), (5, 7)]
    found = invalidated([(at(1), at(2)), (at(5) + 1, at(6)), (at(13), at(14)), (at(29), at(40))], six, at(30), 1)
    assert found == [(at(0), at(6)), (at(12), at(18)), (at(24), at(30))]
    assert invalidated([(at(1), at(2)), (at(13), at(14))], six, at(30), at(60)) == [(at(0), at(18))]  # one chunk of the rollup
    assert invalidated([(at(31), at(33))], six, at(30), 1) == []


ROLLUPS = [
    {"name": "public.six", "of": "public.metrics", "width": 6 * times.HOUR, "keys": ["device_id"], "aggregates": ["count(*) AS n", "max(val) AS top"]},
    {"name": "public.day", "of": "public.six", "width": times.DAY, "keys": ["device_id"], "aggregates": ["sum(n) AS n", "max(top) AS top"]},
]


def _migration(spark, tmp_path, **more):
    return Migration(spark, {"source": str(tmp_path / "s"), "target": str(tmp_path / "t"), "queue": str(tmp_path / "q.json"), "tables": [{"name": "public.metrics", "time": "time", "width": times.CHUNK}]} | more)


def _end():
    return 2**61 // times.DAY * times.DAY + times.ORIGIN % times.DAY


def test_late_rows_refresh_just_their_buckets(spark, metrics, tmp_path):
    """Late rows pass from level to level; copies aren't logged; each entry counts once; a compressed rollup stays whole."""
    own = _migration(spark, tmp_path, rollups=ROLLUPS)
    parent = own.target["public.metrics"]
    parent.append(metrics.filter("time < '2023-05-06' or time >= '2023-05-07'"), log=False)
    for name in ("public.six", "public.day"):
        own._refresh_one(name, own._beginning(name), _end())
    six = own.target["public.six"]
    six.configure(["device_id"], ["bucket"])
    for chunk in six.chunk_starts():
        six.compress_chunk(chunk)
    rows = lambda name: sorted(map(tuple, own.target[name].read().select("bucket", "device_id", "n", "top").collect()))
    full = lambda: {n: sorted(map(tuple, f.select(F.timestamp_micros("bucket").cast("timestamp_ntz"), "device_id", "n", "top").collect())) for n, f in (("public.six", own.rollups["public.six"].of(parent.read())), ("public.day", own.rollups["public.day"].of(own.rollups["public.six"].of(parent.read()).withColumn("bucket", F.timestamp_micros("bucket").cast("timestamp_ntz")))))}
    assert own.refresh_invalidated("public.six") == [] and rows("public.six") == full()["public.six"]
    parent.append(metrics.filter("time >= '2023-05-06 01:00:00' and time < '2023-05-06 08:00:00'"))
    assert rows("public.six") != full()["public.six"]
    found = own.refresh_invalidated("public.six")
    assert [(b - a) // times.HOUR for a, b in found] == [12]
    assert own.refresh_invalidated("public.six") == [] and own.refresh_invalidated("public.day") != []
    assert {n: rows(n) for n in own.rollups} == full()
    assert all(six.tiers(c) == (False, True) for c in six.chunk_starts())
    # a refresh that breaks off reads the log again
    parent.append(metrics.filter("time >= '2023-05-06 08:00:00' and time < '2023-05-07'"))
    work, commit = own.target["public.six"], History.commit
    try:
        History.commit = lambda *_: (_ for _ in ()).throw(OSError("lost"))
        with pytest.raises(OSError, match="lost"):
            own.refresh_invalidated("public.six")
    finally:
        History.commit = commit
    assert work.state().marks["consumed"] < parent.state().generation
    for name in own._in_order():
        own.refresh_invalidated(name)
    assert {n: rows(n) for n in own.rollups} == full()


def test_compressed_tables_are_staged_again(spark, metrics, tmp_path):
    """All chunks compressed: columns are still compared; a snapshot is copied and verified as it was staged; a lost worker changes nothing."""
    own = _migration(spark, tmp_path)
    source, target = own.source["public.metrics"], own.target["public.metrics"]
    source.append(metrics)
    source.configure(["device_id"], ["time"])
    for chunk in source.chunk_starts():
        source.compress_chunk(chunk, 40)
    wanted = _content(source)
    assert own.stage("2023-06-01", snapshot=True) == (4, 0)
    assert target.exists() and target.settings() == source.settings()  # made before any worker runs
    source.overwrite(metrics.withColumn("val", F.lit(0.0)), *[source.chunk_starts()[k] + k for k in (0, -1)])
    assert own.copy(2) == 4 and own.verify(2) == (4, 0)
    assert _content(target) == wanted != _content(source)
    own.queue.clean()
    assert own.stage("2023-06-01") == (4, 0) and own.copy(2) == 4 and own.verify(2) == (4, 0) and _content(target) == _content(source)
    own.queue.clean()
    # a chunk that is cut: if its last step fails, none of its steps counts
    assert own.stage("2023-05-10 07:00:00") == (2, 0)
    compress, before = ChunkedTable.compress_chunk, _content(target)
    source.overwrite(metrics.withColumn("val", F.lit(3.0)), *[source.chunk_starts()[k] + k for k in (0, -1)])
    try:
        ChunkedTable.compress_chunk = lambda *_: (_ for _ in ()).throw(OSError("lost"))
        with pytest.raises(OSError, match="lost"):
            own.copy(1)
    finally:
        ChunkedTable.compress_chunk = compress
    assert _content(target) == before
    own.copy(1)
    cut = dt.datetime(2023, 5, 10, 7)
    assert _content(target) == sorted([r for r in _content(source) if r[0] < cut] + [r for r in before if r[0] >= cut])


def test_verify_names_the_parts_and_counts_jobs(spark, metrics, tmp_path):
    """NaN equals NaN; a changed row is found in its part; jobs don't grow with chunks."""
    own = _migration(spark, tmp_path)
    rows = metrics.withColumn("val", F.when(F.hour("time") == 3, F.lit(float("nan"))).otherwise(F.col("val")))
    own.source["public.metrics"].append(rows)
    changed = F.col("time").cast("string") == "2023-05-13 05:00:00"
    own.target["public.metrics"].append(rows.withColumn("val", F.when(changed, F.lit(0.5)).otherwise(F.col("val"))))
    starts = own.source["public.metrics"].chunk_starts()
    task = lambda s: {"chunk_id": str(s), "table": "public.metrics", "chunk": s, "filter": None, "lower": None, "upper": None, "generation": None}
    tracker = spark.sparkContext.statusTracker()

    def jobs(chunks):
        group = f"verify-{len(chunks)}"
        spark.sparkContext.setJobGroup(group, "")
        out = own._verify_table([task(s) for s in chunks])
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, len(tracker.getJobIdsForGroup(group))

    good = [s for s in starts if not s <= 1683954000000000 < s + times.CHUNK]
    one, few = jobs(good[:1])
    all_good, more = jobs(good)
    assert set(one.values()) == set(all_good.values()) == {"ok"} and more <= few + 1
    found, _ = jobs(starts)
    bad = {c: m for c, m in found.items() if m != "ok"}
    assert len(bad) == 1
    (message,) = bad.values()
    parts = [int(x) for x in message.splitlines()[0].removeprefix("differs in parts from ").split(", ")]
    assert len(parts) == 1 and parts[0] <= 1683954000000000 < parts[0] + times.CHUNK // 64 and "+min_val: 0.5" in message


def test_bounds_that_fit_no_table_are_said(spark, metrics, tmp_path, caplog):
    own = _migration(spark, tmp_path)
    own.source["public.metrics"].append(metrics)
    assert own.stage("5500") == (0, 0)
    assert "skipped public.metrics: until = 5500 is no time" in caplog.text


def test_watermarks_need_no_file_of_data(spark, metrics, tmp_path):
    own = _migration(spark, tmp_path, rollups=ROLLUPS)
    own.target["public.metrics"].append(metrics)
    own._refresh_one("public.six", own._beginning("public.six"), _end())
    last = own.target["public.six"].read().agg(F.max("bucket").alias("m")).first().m
    assert own._watermarks(own.target)["public.six"] == int(last.replace(tzinfo=dt.UTC).timestamp()) * 1_000_000 + 6 * times.HOUR
    assert json.loads((tmp_path / "t" / "public.six" / "_manifest" / f"{own.target['public.six'].state().generation:012d}.json").read_text())["marks"]


def test_chunks_of_two_dimensions(spark, tmp_path):
    """7 time slices by 15 slices of a text column are 105 chunks; each is copied, cut, compressed and verified by itself."""
    rows = generated_series(spark, "2023-05-01 00:00:00", "2023-06-12 00:00:00", "12 HOUR", 200).select("time", F.concat(F.lit("dev"), "device_id").alias("device"), (F.col("device_id") * 1.5).alias("val"))
    own = _migration(spark, tmp_path, tables=[{"name": "public.wide", "time": "time", "width": times.CHUNK, "space": "device", "slices": 15}])
    source, target = own.source["public.wide"], own.target["public.wide"]
    source.append(rows)
    assert len(source.chunk_ids()) == 105 and len(source.chunk_starts()) == 7
    source.configure(["device"], ["time"])
    for chunk in source.chunk_ids()[:3]:
        source.compress_chunk(chunk)
    content = lambda t: sorted(map(tuple, t.read().select("time", "device", "val").collect()))
    assert own.stage("2023-05-13 12:00:00") == (45, 0)
    assert own.copy(8) == 45 and own.verify(4) == (45, 0)
    assert content(target) == [r for r in content(source) if r[0] < dt.datetime(2023, 5, 13, 12)]
    assert len(target.chunk_ids()) == 45 and target.tiers(target.chunk_ids()[0]) == (False, True)
    low = source.chunk_starts()[2]
    assert {r[0] for r in source.read(low, low + 1).select(KEY).distinct().collect()} == {c for c in source.chunk_ids() if c.startswith(f"{low}_")}
    nulls = spark.createDataFrame([(dt.datetime(2023, 5, 1), None, 1.0), (None, "dev1", 2.0)], "time timestamp_ntz, device string, val double")
    source.append(nulls)
    assert source.read().count() == rows.count() + 2 and len(source.chunk_ids()) in (105, 106)


def test_streamed_rollup_merges_partials(spark, metrics, tmp_path):
    """Micro-batches with late rows are merged into stored buckets, compressed ones too; the past isn't read, and a batch delivered twice counts once."""
    from tidemill.streaming.refresh import keep_merged

    daily = Rollup("d", "time", times.DAY, ("device_id",), ("count(*) AS n", "min(val) AS low", "max(val) AS high", "sum(val) AS total"))
    merges = ("sum(n) AS n", "min(low) AS low", "max(high) AS high", "sum(total) AS total")
    table = ChunkedTable(spark, str(tmp_path / "out"), "bucket")
    stream = lambda: spark.readStream.schema(metrics.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    parts = [metrics.filter("hour(time) % 3 = 0"), metrics.filter("hour(time) % 3 = 1 and time < '2023-05-09'"), metrics.filter("hour(time) % 3 > 0 and not (hour(time) % 3 = 1 and time < '2023-05-09')")]
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        keep_merged(stream(), daily, merges, table, str(tmp_path / "cp")).awaitTermination(180)
        if k == 0:
            table.configure(["device_id"], ["bucket"])
            table.compress_chunk(table.chunk_starts()[0])
            before = table.state()
        if k == 1:
            changed = [c for c in table.state().chunks if table.state().chunks[c] != before.chunks.get(c)]
            assert len(changed) == 2 < len(before.chunks)  # only chunks that the batch fell in
    shown = lambda frame: sorted(map(tuple, frame.select(F.unix_micros(F.col("bucket").cast("timestamp")), "device_id", "n", "low", "high", "total").collect()))
    assert shown(table.read()) == shown(daily.of(metrics).withColumn("bucket", F.timestamp_micros("bucket")))
    assert table.tiers(table.chunk_starts()[0]) == (False, True) and table.touched_since(0)
    # the same batches again, as after a lost checkpoint, are known by their number
    last = table.state().generation
    keep_merged(stream(), daily, merges, table, str(tmp_path / "cp2")).awaitTermination(180)
    assert table.state().generation == last


def test_chunks_of_another_database(spark, metrics, tmp_path):
    """An embedded database is read with a predicate a chunk, each in a partition of its own, copied by route, and verified."""
    from tidemill.sources.store import jdbc_table

    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    stamped = metrics.select(F.col("time").cast("timestamp").alias("TIME"), F.col("device_id").alias("DEVICE"), F.col("val").alias("VAL"))
    stamped.coalesce(1).write.jdbc(url, "METRICS", properties=driver)
    source = ChunkedTable(spark, str(tmp_path / "s" / "public.metrics"), "TIME", "timestamptz")
    starts = [r[0] for r in stamped.select(times.chunk_start(F.col("TIME"), "timestamptz")).distinct().orderBy(F.col(stamped.select(times.chunk_start(F.col("TIME"), "timestamptz")).columns[0])).collect()]
    at = lambda m: (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=m)).strftime("%Y-%m-%d %H:%M:%S")
    predicates = [f"TIME >= TIMESTAMP('{at(s)}') AND TIME < TIMESTAMP('{at(s + times.CHUNK)}')" for s in starts]
    rows = jdbc_table(spark, url, "METRICS", None, predicates, **driver)
    assert rows.rdd.getNumPartitions() == len(starts) == 4
    assert [r.n for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()] == [r.n for r in stamped.groupBy(times.chunk_start(F.col("TIME"), "timestamptz").alias("c")).agg(F.count("*").alias("n")).orderBy("c").collect()]
    source.append(rows)
    own = _migration(spark, tmp_path, tables=[{"name": "public.metrics", "time": "TIME", "kind": "timestamptz", "width": times.CHUNK}])
    assert own.stage("2023-05-15") == (3, 0) and own.copy(2) == 3 and own.verify(2) == (3, 0)
    kept = sorted(map(tuple, own.target["public.metrics"].read().drop(KEY).collect()))
    assert kept == sorted(map(tuple, stamped.filter("TIME < '2023-05-15'").collect()))


def _known_rows(spark, sql):
    """The optimiser's row count of a query's root."""
    import re

    first = spark.sql(f"EXPLAIN COST {sql}").first()[0].split("== Optimized Logical Plan ==")[1].strip().splitlines()[0]
    found = re.search(r"rowCount=([0-9.E+]+)", first)
    return None if found is None else float(found[1])


def test_the_optimiser_knows_copied_tables(spark, metrics, tmp_path):
    """A copy registers and analyses its tables; only changed partitions and generations are worked on again; joins are planned by the counts."""
    from tidemill.sources import statistics

    spark.sql("CREATE DATABASE IF NOT EXISTS copied")
    own = _migration(spark, tmp_path, metastore="copied", statistics={"public.metrics": ["device_id"]})
    source, target = own.source["public.metrics"], own.target["public.metrics"]
    source.append(metrics)
    source.append(metrics.limit(3).withColumn("time", F.lit(None).cast("timestamp_ntz")))
    assert own.stage("2023-05-30")[0] == len(source.chunk_starts()) and own.copy(2) == len(source.chunk_starts())
    full, count = "`copied`.`public_metrics`", metrics.count()
    assert statistics.row_count(spark, full) == count == spark.table(full).count()
    known = statistics.column_statistics(spark, full, "device_id")
    assert (known["min"], known["max"], known["num_nulls"], known["distinct_count"]) == ("1", "2", "0", "2")
    assert own.analyze() == []  # this generation was analysed
    try:
        spark.conf.set("spark.sql.cbo.enabled", "true")
        spark.catalog.refreshTable(full)
        assert _known_rows(spark, f"SELECT * FROM {full}") == count
        assert _known_rows(spark, f"SELECT * FROM {full} WHERE device_id = 1") == count / 2
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
    # one chunk is compressed: its rows leave the one table and are batches of the other
    first, left = target.chunk_starts()[0], count - metrics.filter(times.chunk_start(F.col("time")) == target.chunk_starts()[0]).count()
    target.configure(["device_id"], ["time"])
    target.compress_chunk(first)
    assert own.analyze() == [full, "`copied`.`public_metrics_batches`"]
    assert statistics.row_count(spark, full) == left == spark.table(full).count()
    assert statistics.row_count(spark, "`copied`.`public_metrics_batches`") == 2
    # the source has rows without a time
    statistics.analyze(source, "copied.all_rows")
    assert statistics.row_count(spark, "`copied`.`all_rows`") == count + 3
    with pytest.raises(ValueError, match="another table"):
        statistics.register(target, "copied.all_rows")
    for table, name in ((target, "copied.public_metrics"), (source, "copied.all_rows")):
        statistics.drop(table, name)
    assert target.read().count() == count and source.read().count() == count + 3


def test_a_chunk_with_most_rows_is_written_by_many_tasks(spark, metrics, tmp_path):
    """Few files where chunks are small, several where one is larger than the advisory size; nothing is lost."""
    table = ChunkedTable(spark, str(tmp_path), "time")
    rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 100 == 0, F.timestamp_seconds(F.lit(1683000000) + F.floor(F.col("id") / 100) % 20 * 86400)).otherwise(F.timestamp_seconds(F.lit(1683000000))).cast("timestamp_ntz").alias("time"), F.sha2(F.col("id").cast("string"), 256).alias("val"))
    files = lambda chunk: sum(n.endswith(".parquet") for p in table.state().pieces(str(chunk), "rows") for n in table.files.names(f"{table.path}/rows/{p['folder']}"))
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
        assert table.append(rows) == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot, *others = table.chunk_starts()
    before = {c: files(c) for c in (hot, *others)}
    assert files(hot) >= 4 and len(others) == 3
    table.append(rows.filter("id % 100 = 0"))  # small again: a file a chunk
    assert all(files(c) <= files_of_large + 1 for c, files_of_large in before.items())
    assert table.read().select(F.countDistinct("val")).first()[0] == 200_000 and table.read().count() == 202_000


def test_refreshes_go_by_level_then_window(spark, tmp_path):
    from types import SimpleNamespace as Window

    more = [{"name": f"public.{n}", "of": of, "width": times.DAY, "keys": [], "aggregates": ["count(*) AS n"]} for n, of in (("a", "public.metrics"), ("b", "public.metrics"), ("c", "public.metrics"), ("d", "public.b"))]
    own = _migration(spark, tmp_path, rollups=more)
    windows = {"public.a": Window(window_start=9), "public.b": Window(window_start=3), "public.d": Window(window_start=1)}
    assert own._in_order(windows) == ["public.b", "public.a", "public.c", "public.d"]
    assert own._in_order() == ["public.a", "public.b", "public.c", "public.d"]


def test_bounds_are_refused_by_kind(spark):
    from tidemill.plans.planner import check_bound

    for value, message in (("99999999999999999999", "no valid bigint"), ("2023-13-45", "no valid time"), ("soon", "no valid time")):
        with pytest.raises(ValueError, match=message):
            check_bound(spark, "until", value)
    for value in ("17", "2023-05-01", "2023-05-01 10:00:00"):
        check_bound(spark, "until", value)

"""Commands over a configuration file: stage, copy, verify, refresh, clean.

Each ends with a line that says what it did. Chunks are copied by a route that
depends on both sides' tiers: compressed chunks that are wanted whole go over
as batches, unread; where a range cuts a chunk, rows are replaced and the
target is compressed again. All steps of a chunk count together or not at all.
Staging checks columns, the format's version and compression settings of both
sides, names the tables whose time a bound doesn't fit, and makes the tables
that the target lacks. With ``--snapshot`` a chunk is copied and verified as it
was in the source when it was staged.

The configuration is JSON: source and target folders, the queue's and the
event log's files, and tables with name, time column, type and chunk width, and
maybe a second dimension: space, a column of any type, and slices, their number.
Rollups, each after what it is built on, have name, of (a table or a rollup),
width, keys, aggregates, and the chunk width of their storage; their bucket is
stored as a value of the table's time type. The session that all commands from
the first one to clean report is kept in a file of its own.

A refresh works level by level. First come the buckets below a rollup's
watermark that writes to its parent touched since it was last refreshed; then
what lies between the target's watermark and the source's. Rows, watermark and
how far the parent's log was read are one generation of the rollup, so each
entry counts once. Copies aren't logged unless ``--invalidate`` is given, so
backfilled rows don't refresh what was copied too. Without a stored watermark
the target's is the end of its last bucket, and an empty rollup is computed from
its parent's beginning. Where the target's parent ends before the source's
watermark, the stored one is the start of the last bucket, and the next refresh
goes on there.

With metastore, the name of a database, copied tables are registered there after
a copy, with ``_`` for the dot in their names, and analysed; statistics names
columns by table that are described too.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import signal
import threading
import time
import uuid

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.idents import assert_regex
from tidemill.functions.times import CHUNK, INTEGER_TYPES, ORIGIN, floor_to, from_internal, internal, parse_bound
from tidemill.operators.compression import assert_same_settings
from tidemill.operators.copying import route
from tidemill.operators.rollups import Rollup, refresh, within
from tidemill.operators.validation import assert_same_columns, signatures
from tidemill.operators.verification import difference_report, differing_parts, verify_chunks
from tidemill.plans.planner import check_bound, closure, invalidated, plan_chunks, refresh_plan, seeds, skipped_tables
from tidemill.plans.taskqueue import TaskQueue, with_priority
from tidemill.sources import statistics
from tidemill.sources.store import KEY, ChunkedTable
from tidemill.telemetry import Event, human_bytes, human_seconds, report

log = logging.getLogger("tidemill")
#: Parts of a chunk that a failed verification looks at.
PARTS = 64


class Migration:
    """Chunked tables of a source folder and their counterparts in a target folder."""

    def __init__(self, spark: SparkSession, config: dict):
        self.spark, self.config = spark, config
        self.queue, self.invalidate = TaskQueue(config["queue"]), bool(config.get("invalidate", False))
        self.tables, self.rollups, self.parent = list(config["tables"]), {}, {}
        for r in config.get("rollups", []):
            above = next(t for t in self.tables if t["name"] == r["of"])
            kind = above.get("kind", "timestamp")
            self.tables.append({"name": r["name"], "time": "bucket", "kind": kind, "width": r.get("chunk", CHUNK)})
            self.rollups[r["name"]] = Rollup(r["name"], above["time"], r["width"], tuple(r["keys"]), tuple(r["aggregates"]), kind)
            self.parent[r["name"]] = r["of"]
        self.session_file = config.get("session", f"{config['queue']}.session")
        space = lambda t: (t["space"], t["slices"]) if "space" in t else None
        side = lambda folder: {t["name"]: ChunkedTable(spark, f"{config[folder]}/{t['name']}", t["time"], t.get("kind", "timestamp"), t["width"], space=space(t)) for t in self.tables}
        self.source, self.target = side("source"), side("target")

    def _catalogue(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        tables = [(k, *t["name"].split(".", 1)) for k, t in enumerate(self.tables)]
        dims = [(k, k, t["time"], t.get("kind", "timestamp")) for k, t in enumerate(self.tables)]
        rows = []
        for k, t in enumerate(self.tables):
            if not self.source[t["name"]].exists():
                if t["name"] in self.rollups:
                    continue  # never refreshed
                raise ValueError(f"{t['name']} is missing in the source")
            own = self.source[t["name"]]
            rows += [(k, f"{t['name']}/{c}", own._start(str(c)), own._start(str(c)) + t["width"], False) for c in own.chunk_ids()]
        chunks = self.spark.createDataFrame(rows, "hypertable_id int, chunk_id string, range_start long, range_end long, dropped boolean")
        return chunks, self.spark.createDataFrame(tables, "id int, schema_name string, table_name string"), self.spark.createDataFrame(dims, "id int, hypertable_id int, column_name string, column_type string")

    def _rollup_frame(self) -> DataFrame:
        at = {t["name"]: k for k, t in enumerate(self.tables)}
        rows = [(at[n], at[self.parent[n]], *n.split(".", 1)) for n in self.rollups]
        return self.spark.createDataFrame(rows, "mat_id int, raw_id int, view_schema string, view_name string")

    def _chosen(self, tables: DataFrame, pattern: str, up: bool, down: bool) -> DataFrame:
        assert_regex(self.spark, pattern)
        return closure(seeds(tables, self._rollup_frame(), pattern), self._rollup_frame(), up, down)

    def _bounds(self, *texts: str | None) -> dict[str, tuple]:
        """By type of time: the bounds as internal values."""
        kinds = sorted({t.kind for t in self.source.values()})
        read = lambda k: [F.lit(None).cast("bigint") if t is None else parse_bound(F.lit(t), F.lit(k)) for t in texts]
        row = self.spark.range(1).select(*[F.array(*read(k)).alias(k) for k in kinds]).first()
        return {k: tuple(row[k]) for k in kinds}

    def stage(self, until: str, frm: str | None = None, pattern: str | None = None, up: bool = False, down: bool = False, snapshot: bool = False) -> tuple[int, int]:
        """Chunks of the tables and rollups that the pattern names; up: and of all rollups on them; down: and of all they are built on."""
        check_bound(self.spark, "until", until)
        if frm is not None:
            check_bound(self.spark, "from", frm)
        chunks, tables, dims = self._catalogue()
        if pattern is not None:
            tables = tables.join(self._chosen(tables, pattern, up, down), "id", "left_semi")
        planned = with_priority(plan_chunks(chunks, tables, dims, until, frm)).orderBy("priority").collect()
        for name, bound in (("until", until), ("from", frm)):
            for r in skipped_tables(tables, dims, bound).orderBy("hypertable").collect() if bound is not None else []:
                log.warning("skipped %s: %s = %s is no %s", r.hypertable, name, bound, "integer" if r.column_type in INTEGER_TYPES else "time")
        both = {n: t for n, t in self.target.items() if t.exists() and (n not in self.rollups or self.source[n].exists())}
        bare = lambda side: signatures(self.spark, {n: side[n].read().drop(KEY) for n in both})
        for name in both:
            assert_same_settings(name, self.source[name].settings(), self.target[name].settings())
        if both:
            assert_same_columns(bare(self.source), bare(self.target))
        for name, table in self.target.items():  # a table that the target lacks is made like the source's, before any worker runs
            if not table.exists() and self.source[name].exists():
                table.create_like(self.source[name])
        bounds, generations, tasks = self._bounds(frm, until), {}, []
        for r in planned:
            name, chunk = r.chunk_id.rsplit("/", 1)
            if name not in generations:
                generations[name] = self.source[name].state().generation
            low, high = bounds[self.source[name].kind]
            cut = {"lower": low if low is not None and low >= r.range_start else None, "upper": high if high < r.range_end else None}
            tasks.append({"hypertable": r.hypertable, "chunk_id": r.chunk_id, "table": name, "chunk": chunk if self.source[name].space else int(chunk), "range_start": r.range_start, "filter": r["filter"], **cut, "generation": generations[name] if snapshot else None})
        return self.queue.enqueue(tasks)

    def _source_of(self, task: dict) -> ChunkedTable:
        """The source, as it was when a task of a snapshot was staged."""
        own = self.source[task["table"]]
        return own if task["generation"] is None else own.at(task["generation"])

    @staticmethod
    def _range(task: dict, table: ChunkedTable, rows: DataFrame) -> Column | None:
        """The part of a chunk that a task is about, on the table's own time; None for the whole."""
        if task["lower"] is None and task["upper"] is None:
            return None
        return within(F.col(f"`{table.time}`"), rows.schema[table.time].dataType, task["lower"], task["upper"])

    def copy_one(self, task: dict) -> str:
        began, chunk, source, filtered = time.time(), task["chunk"], self._source_of(task), bool(task["filter"])
        (rows, batches), count = source.tiers(chunk), 0
        if not rows and not batches:
            return "skipped: the source chunk is gone"
        before = sum(p["bytes"] for pieces in source.state().chunks[str(chunk)].values() for p in pieces)
        with self.target[task["table"]].change(log=self.invalidate) as target:
            target_rows, target_batches = target.tiers(chunk)
            steps = route(filtered, batches, target_batches, target_rows, rows)
            for step in steps:
                if step == "decompress target":
                    target.decompress_chunk(chunk)
                elif step == "compress target":
                    target.compress_chunk(chunk)
                elif step == "replace range from both tiers":
                    own = source.content(chunk)
                    count += target.replace(own.drop(KEY), chunk, self._range(task, source, own))
                elif step in ("append compressed batches", "create compressed chunk with batches"):
                    count += target.replace_batches(source.batches(chunk).drop(KEY), chunk)  # a whole chunk replaces what was there
                elif rows or target_rows:  # the row tier, as a whole or in the range
                    own = source.rows(chunk)
                    own = target.rows(chunk).limit(0) if own is None else own
                    count += target.replace(own.drop(KEY), chunk, self._range(task, source, own))
        seconds = time.time() - began
        return f"{count} rows and batches, {human_bytes(before)} in {human_seconds(seconds)} ({human_bytes(before / max(seconds, 1e-9))} a second), {', '.join(steps)}"

    def _verify_table(self, tasks: list[dict]) -> dict[str, str]:
        """A message by chunk id for chunks of one table: one aggregation a side, and one more where some differ."""
        source, target = self._source_of(tasks[0]), self.target[tasks[0]["table"]]
        ids = [t["chunk"] for t in tasks]
        sides, there = [], [set(source.chunk_ids()), set(target.chunk_ids())]
        for side in (source, target):
            rows, wanted = side.of_chunks(ids), F.lit(False)
            for cut in {(t["lower"], t["upper"]) for t in tasks}:  # few: a stage has two bounds
                own = [t for t in tasks if (t["lower"], t["upper"]) == cut]
                inside = self._range(own[0], source, rows)
                some = F.col(KEY).isin([t["chunk"] for t in own])
                wanted = wanted | (some if inside is None else some & inside)
            sides.append(rows.filter(wanted))
        planned = self.spark.createDataFrame([(s,) for s in ids], f"{KEY} {source.key_type}")
        found = {r[KEY]: r for r in verify_chunks(*sides, planned, KEY, details=True).collect()}  # a row a chunk
        out, wrong = {}, []
        for t in tasks:
            r = found[t["chunk"]]
            if t["chunk"] not in there[0] or t["chunk"] not in there[1]:
                out[t["chunk_id"]] = f"{'source' if t['chunk'] not in there[0] else 'target'} chunk is missing"
            elif r.s["total_count"] is None and r.t["total_count"] is None or r.status == "ok":
                out[t["chunk_id"]] = "ok"  # a range may be empty on both sides
            else:
                wrong.append(t)
        if wrong:
            part = floor_to(internal(F.col(f"`{source.time}`"), source.kind), max(source.width // PARTS, 1))
            some = F.col(KEY).isin([t["chunk"] for t in wrong])
            parts: dict = {}
            for r in differing_parts(*[side.filter(some) for side in sides], KEY, part).collect():  # at most PARTS a chunk, and one
                parts.setdefault(r[KEY], []).append(r.part)
            for t in wrong:
                r = found[t["chunk"]]
                text = difference_report({k: v for k, v in r.s.asDict().items()}, {k: v for k, v in r.t.asDict().items()})
                out[t["chunk_id"]] = f"differs in parts from {', '.join(map(str, sorted(parts.get(t['chunk'], []), key=str)))}\n{text}"
        return out

    def session(self) -> str:
        """The id that all commands from the first one to clean share; made where it is missing."""
        if not os.path.exists(self.session_file):
            aside = f"{self.session_file}.new"
            with open(aside, "w") as file:
                json.dump({"id": uuid.uuid4().hex, "created": time.time()}, file)
            os.replace(aside, self.session_file)
        with open(self.session_file) as file:
            return json.load(file)["id"]

    def clean(self) -> None:
        """Removes the queue, the session, and what broken-off runs left in the target."""
        self.queue.clean()
        if os.path.exists(self.session_file):
            os.remove(self.session_file)
        for table in self.target.values():
            table.clean()

    def copy(self, parallelism: int = 8, stop: threading.Event | None = None) -> int:
        done = self.queue.drain(self.copy_one, parallelism, stop=stop)
        self.analyze()
        return done

    def analyze(self) -> list[str]:
        """Statistics of copied tables in the metastore, if the configuration names a database of it; returns what was analysed."""
        database, columns, out = self.config.get("metastore"), self.config.get("statistics", {}), []
        for name in sorted({t["table"] for t in self.queue.tasks if t["worked"]}) if database else []:
            out += statistics.analyze(self.target[name], f"{database}.{name.replace('.', '_')}", columns.get(name))
        for full in out:
            log.warning("analysed %s: %s rows", full, statistics.row_count(self.spark, full))
        return out

    def verify(self, parallelism: int = 8, stop: threading.Event | None = None) -> tuple[int, int]:
        """(done, failures): a missing chunk is a message, not a failure. Tables are verified side by side, each in a job or two whatever its chunks."""
        groups: dict = {}
        for task in self.queue.claim_all(True):
            groups.setdefault((task["table"], task["generation"]), []).append(task)

        def work(tasks: list[dict]) -> int:
            began, messages = time.time(), None
            try:
                if stop is None or not stop.is_set():
                    messages = self._verify_table(tasks)
            finally:
                if messages is None:
                    for task in tasks:
                        self.queue.give_back(task)
            if messages is None:
                return 0
            for number, task in enumerate(tasks, 1):
                message = messages[task["chunk_id"]]
                self.queue.complete(task, began, message, True)
                log.warning("[%d/%d] %s: %s", number, len(tasks), task["chunk_id"], message.splitlines()[0])
            return len(tasks)

        with ThreadPoolExecutor(parallelism) as pool:
            done = sum(pool.map(work, groups.values()))
        return done, sum((t["message"] or "").startswith("differs") for t in self.queue.tasks)

    def _stored(self, table: ChunkedTable, *bounds: int) -> DataFrame | None:
        """A rollup's rows with the bucket as internal time."""
        return table.read(*bounds).drop(KEY).withColumn("bucket", internal(F.col("bucket"), table.kind)) if table.exists() else None

    def _saved(self) -> dict[str, int]:
        marks = {n: self.target[n].state().marks.get("watermark") for n in self.rollups}
        return {n: m for n, m in marks.items() if m is not None}

    def _watermarks(self, side: dict[str, ChunkedTable]) -> dict[str, int]:
        """By rollup: the end of its last bucket, from the manifest."""
        out = {}
        for name in self.rollups:
            highs = [p["high"] for entry in side[name].state().chunks.values() for pieces in entry.values() for p in pieces if p["high"] is not None]
            if highs:
                out[name] = max(highs) + self.rollups[name].width
        return out

    def _beginning(self, name: str) -> int:
        """A bucket edge before all time."""
        rollup = self.rollups[name]
        shift = 0 if rollup.kind in INTEGER_TYPES else ORIGIN % rollup.width
        return shift - (2**61 // rollup.width) * rollup.width

    def refresh(self, pattern: str | None = None, up: bool = False, down: bool = False) -> int:
        """Brings the target's rollups up to the source's watermarks, parents first; returns the windows refreshed."""
        if not self.rollups:
            return 0
        rollups = self._rollup_frame()
        own = {n: self._beginning(n) for n in self.rollups} | self._watermarks(self.target) | self._saved()
        marks = lambda found: self.spark.createDataFrame([(*n.split(".", 1), self.rollups[n].kind, m) for n, m in found.items() if n in self.rollups], "view_schema string, view_name string, column_type string, watermark long")
        plan = refresh_plan(rollups, marks(self._watermarks(self.source)), marks(own))
        if pattern is not None:
            tables = self.spark.createDataFrame([(k, *t["name"].split(".", 1)) for k, t in enumerate(self.tables)], "id int, schema_name string, table_name string")
            chosen = rollups.join(self._chosen(tables, pattern, up, down).withColumnRenamed("id", "mat_id"), "mat_id", "left_semi")
            plan = plan.join(chosen, ["view_schema", "view_name"], "left_semi")
        windows = {f"{w.view_schema}.{w.view_name}": w for w in plan.collect()}  # a row a rollup
        if not windows:
            log.warning("no rollups to refresh")
        names = set(self.rollups) if pattern is None else {f"{r.view_schema}.{r.view_name}" for r in rollups.join(chosen, "mat_id", "left_semi").collect()}
        number = 0
        for name in [n for n in self._in_order(windows) if n in names]:
            self.refresh_invalidated(name)
            if name in windows:
                w, number = windows[name], number + 1
                log.warning("[%d/%d] refresh %s in [%s, %s)", number, len(windows), name, w.start_text, w.end_text)
                self._refresh_one(name, w.window_start, w.window_end)
        return len(windows)

    def _in_order(self, windows: dict | None = None) -> list[str]:
        """Rollups by level, then by the start of their window, those without one last, then by name."""
        windows = windows or {}
        level = lambda n: 0 if self.parent[n] not in self.rollups else 1 + level(self.parent[n])
        return sorted(self.rollups, key=lambda n: (level(n), n not in windows, windows[n].window_start if n in windows else 0, n))

    def _above(self, name: str) -> ChunkedTable:
        """What a rollup is built on, as it is now."""
        above = self.target[self.parent[name]]
        if not above.exists():
            raise ValueError(f"{name}: {self.parent[name]} is missing in the target")
        return above.snapshot()

    def _recompute(self, name: str, table: ChunkedTable, above: ChunkedTable, start: int, end: int) -> int:
        rollup = self.rollups[name]
        parent, stored = above.read(start, end).drop(KEY), self._stored(table, start, end)
        new = refresh(rollup, rollup.of(parent).limit(0) if stored is None else stored, parent, start, end)
        return table.overwrite(new.withColumn("bucket", from_internal(F.col("bucket"), rollup.kind)), start, end)

    def refresh_invalidated(self, name: str) -> list[tuple[int, int]]:
        """Recomputes the buckets below the watermark that logged writes to the parent touched; returns their ranges."""
        rollup, table = self.rollups[name], self.target[name]
        marks = table.state().marks
        mark = marks.get("watermark", self._watermarks(self.target).get(name))
        if mark is None:
            return []  # nothing is materialised
        above = self._above(name)
        ranges = invalidated(above.touched_since(marks.get("consumed", 0)), rollup, mark, table.width)
        with table.change() as work:
            for start, end in ranges:
                log.warning("refresh %s again in [%d, %d)", name, start, end)
                self._recompute(name, work, above, start, end)
            work._work.marks["consumed"] = above.generation
        return ranges

    def _refresh_one(self, name: str, start: int, end: int) -> None:
        rollup, above = self.rollups[name], self._above(name)
        with self.target[name].change() as table:
            count = self._recompute(name, table, above, start, end)
            last = rollup.watermark(self._stored(table, start, end).filter(F.col("bucket") < end)).first() if count else None
            # a parent that isn't copied up to the source's watermark may end within its last bucket
            table._work.marks["watermark"] = start if last is None else end if last.watermark >= end else max(start, last.watermark - rollup.width)
            table._work.marks.setdefault("consumed", above.generation)
        log.warning("refreshed %s in [%d, %d)", name, start, end)


def graceful(spark: SparkSession) -> threading.Event:
    """First interrupt: finish what runs. Second: cancel all jobs."""
    stop = threading.Event()

    def handle(*_) -> None:
        if stop.is_set():
            spark.sparkContext.cancelAllJobs()
        stop.set()

    signal.signal(signal.SIGINT, handle)
    return stop


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemill", description=__doc__)
    parser.add_argument("command", choices=["stage", "copy", "verify", "refresh", "clean"])
    parser.add_argument("--config", required=True)
    parser.add_argument("--until")
    parser.add_argument("--from", dest="frm")
    parser.add_argument("--filter")
    parser.add_argument("--cascade-up", action="store_true")
    parser.add_argument("--cascade-down", action="store_true")
    parser.add_argument("--snapshot", action="store_true", help="copy chunks as they are when they are staged")
    parser.add_argument("--invalidate", action="store_true", help="copied rows refresh rollups below their watermark")
    parser.add_argument("--no-telemetry", action="store_true", help="write no event")
    parser.add_argument("--parallelism", type=int, default=8)
    options = parser.parse_args(args)
    with open(options.config) as file:
        config = json.load(file)
    spark = SparkSession.builder.appName("tidemill").config("spark.sql.session.timeZone", "UTC").config("spark.scheduler.mode", "FAIR").getOrCreate()
    logging.basicConfig(level=os.environ.get("TIDEMILL_LOG", "WARNING").upper())
    event = Event(options.command, spark=spark.version, filtered=options.filter is not None, cascade=[d for d, on in (("up", options.cascade_up), ("down", options.cascade_down)) if on], parallelism=options.parallelism, tables=len(config["tables"]), rollups=len(config.get("rollups", [])))
    migration = Migration(spark, config)
    migration.invalidate |= options.invalidate
    event.session = migration.session()
    try:
        if options.command == "stage":
            staged, skipped = migration.stage(options.until, options.frm, options.filter, options.cascade_up, options.cascade_down, options.snapshot)
            event.tasks = staged
            log.warning("staged %d chunks, skipped %d", staged, skipped)
        elif options.command == "clean":
            migration.clean()
            log.warning("removed the queue and what runs left behind")
        elif options.command == "refresh":
            event.tasks = migration.refresh(options.filter, options.cascade_up, options.cascade_down)
            log.warning("refreshed %d windows", event.tasks)
        elif options.command == "copy":
            event.tasks = migration.copy(options.parallelism, graceful(spark))
            log.warning("copied %d chunks, %d are pending", event.tasks, migration.queue.count_pending())
        else:
            event.tasks, failures = migration.verify(options.parallelism, graceful(spark))
            log.warning("verified %d chunks, %d differ", event.tasks, failures)
            return int(failures > 0)
    except Exception as error:
        event.fail(error)
        raise
    finally:
        event.seconds = time.time() - event.began
        if config.get("events") and not options.no_telemetry:
            report(event, config["events"])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

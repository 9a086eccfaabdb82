"""Chunked tables: Parquet folders by chunk, in a row tier and a compressed tier, under a versioned manifest.

Each write goes to folders of its own, ``<tier>/_v=<id>/_chunk=<start>``; then
one new generation of the manifest says what the chunks are made of now. So a
copy, compression, decompression or refresh counts as a whole or not at all, a
run that breaks off anywhere can be done again, and a frame goes on reading the
generation that it was made from. ``clean`` deletes folders that no generation
names, ``vacuum`` old generations with what only they name.

A chunk may have rows, batches, or both (it is then partial). The manifest also
keeps each piece's rows, bytes and range of times, which the write observes
itself, so the catalogue is read without opening a file.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.times import CHUNK, chunk_start, hash_slice, internal
from tidemill.operators.compression import BATCH, compress, decompress, skipping, triples
from tidemill.operators.copying import replace_range
from tidemill.operators.rollups import time_range
from tidemill.sources.manifest import TIERS, History, Manifest
from tidemill.sources.places import Files

KEY = "_chunk"
#: Version of the folders' layout; both sides of a copy must have the same.
FORMAT = 2
#: The chunk of rows without a time: they are in no range.
NO_CHUNK = "none"
_VERSION, _HIVE_NULL = "_v", "__HIVE_DEFAULT_PARTITION__"


def _nullable(schema):
    """A schema's JSON with everything nullable, as files hold it."""
    if isinstance(schema, list):
        return [_nullable(x) for x in schema]
    if isinstance(schema, dict):
        return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else _nullable(v) for k, v in schema.items()}
    return schema


class ChunkedTable:
    def __init__(self, spark: SparkSession, path: str, time: str, kind: str = "timestamp", width: int = CHUNK, generation: int | None = None, space: tuple[str, int] | None = None):
        """generation: reads that one, as a snapshot that can't be written. space: a second dimension, a column of any type and its number of slices."""
        self.spark, self.path, self.time, self.kind, self.width, self.generation, self.space = spark, path.rstrip("/"), time, kind, width, generation, space
        self.files = Files(spark, self.path)
        self.history = History(self.files, f"{self.path}/_manifest")
        self._work: Manifest | None = None
        self._touched: list[tuple[int, int]] = []

    # what there is

    def state(self) -> Manifest:
        return self._work if self._work is not None else self.history.load(self.generation)

    def snapshot(self) -> ChunkedTable:
        """The table as it is now, for as long as its generation is kept."""
        return self.at(self.state().generation)

    def at(self, generation: int | None) -> ChunkedTable:
        return ChunkedTable(self.spark, self.path, self.time, self.kind, self.width, generation, self.space)

    def keyed(self, rows: DataFrame) -> DataFrame:
        """Adds the chunk of each row: the start of its time slice, and, with a second dimension, ``start_slice``."""
        start = chunk_start(F.col(self.time), self.kind, self.width)
        if self.space is None:
            return rows.withColumn(KEY, start)
        column, parts = self.space
        return rows.withColumn(KEY, F.when(start.isNotNull(), F.concat_ws("_", start.cast("string"), hash_slice(F.col(f"`{column}`"), parts).cast("string"))))

    def _gathered(self, rows: DataFrame) -> DataFrame:
        """Keyed rows brought together by chunk, so that few files are written; a chunk with many rows is split over tasks of about the advisory size."""
        return self.keyed(rows).hint("rebalance", F.col(KEY))

    @property
    def key_type(self) -> str:
        return "long" if self.space is None else "string"

    def _start(self, chunk: str) -> int:
        return int(chunk.partition("_")[0])

    def _key(self, chunk: int | str) -> Column:
        return F.lit(chunk).cast(self.key_type)

    def exists(self) -> bool:
        return bool(self.state().schemas)

    def settings(self) -> dict:
        """{version, segment_by, order_by}; a table without settings has the current version and isn't compressed."""
        return self.state().settings or {"version": FORMAT, "segment_by": None, "order_by": None}

    def tiers(self, chunk: int | str) -> tuple[bool, bool]:
        """Whether the chunk has rows, and whether it has batches."""
        state = self.state()
        return bool(state.pieces(str(chunk), "rows")), bool(state.pieces(str(chunk), "batches"))

    def chunk_starts(self) -> list[int]:
        """Starts of the chunks in either tier: no file of data is opened. Rows without a time are in no chunk."""
        return sorted({self._start(c) for c in self.state().chunks if c != NO_CHUNK})

    def chunk_ids(self) -> list[int | str]:
        """The chunks themselves: starts, or start and slice of a second dimension."""
        known = [c for c in self.state().chunks if c != NO_CHUNK]
        return sorted(known, key=lambda c: (self._start(c), c)) if self.space else sorted(map(int, known))

    def chunks(self) -> DataFrame:
        """(chunk, range_start, range_end, n, batches, bytes, low, high) of the chunks, from the manifest; low and high are the least and greatest time."""
        out = []
        for chunk, entry in self.state().chunks.items():
            both = [p for t in TIERS for p in entry.get(t, [])]
            known = [p for p in both if p["low"] is not None]
            start = None if chunk == NO_CHUNK else self._start(chunk)
            out.append((None if chunk == NO_CHUNK else chunk, start, None if start is None else start + self.width, sum(p["rows"] for p in both), sum(p["n"] for p in entry.get("batches", [])), sum(p["bytes"] for p in both), min((p["low"] for p in known), default=None), max((p["high"] for p in known), default=None)))
        return self.spark.createDataFrame(out, "chunk string, range_start long, range_end long, n long, batches long, bytes long, low long, high long")

    # reading

    def _schema(self, tier: str, state: Manifest) -> StructType | None:
        kept = state.schemas.get(tier)
        return None if kept is None else StructType.fromJson(kept)

    def _frame(self, tier: str, chunks: list[str], state: Manifest) -> DataFrame | None:
        """The tier of these chunks with the chunk's key; None if the tier has never been."""
        schema = self._schema(tier, state)
        if schema is None:
            return None
        full = StructType([*schema.fields]).add(KEY, self.key_type)
        folders = [p["folder"] for c in chunks for p in state.pieces(c, tier)]
        if not folders:
            return self.spark.createDataFrame([], full)
        base = f"{self.path}/{tier}"
        return self.spark.read.schema(StructType([*full.fields]).add(_VERSION, "string")).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).drop(_VERSION)

    def rows(self, chunk: int | str) -> DataFrame | None:
        """The row tier of one chunk."""
        state = self.state()
        return self._frame("rows", [str(chunk)], state) if state.pieces(str(chunk), "rows") else None

    def batches(self, chunk: int | str) -> DataFrame | None:
        """The batches of one chunk, as they are stored."""
        state = self.state()
        return self._frame("batches", [str(chunk)], state) if state.pieces(str(chunk), "batches") else None

    def content(self, chunk: int | str) -> DataFrame | None:
        """The rows of both tiers of one chunk."""
        state = self.state()
        return self._both([str(chunk)], state) if str(chunk) in state.chunks else None

    def _both(self, chunks: list[str], state: Manifest, where: dict | None = None) -> DataFrame:
        rows, packed = self._frame("rows", chunks, state), self._frame("batches", chunks, state)
        if packed is not None:
            if where:
                packed = packed.filter(skipping(where, packed, (state.settings or {}).get("segment_by") or []))
            flat = decompress(packed, self._columns(packed) if rows is None else rows.columns)
            rows = flat if rows is None else rows.unionByName(flat)
        if rows is None:
            raise ValueError(f"{self.path}: no such table")
        return rows

    @staticmethod
    def _columns(batches: DataFrame) -> list[str]:
        inner = [f.name for f in batches.schema["_rows"].dataType.elementType]
        return [c for c in batches.columns if not c.startswith("_") and c not in inner] + inner + [KEY]

    def of_chunks(self, chunks: list[int | str]) -> DataFrame:
        """The rows of both tiers of some chunks."""
        state = self.state()
        return self._both([str(c) for c in chunks if str(c) in state.chunks], state)

    def _overlapping(self, state: Manifest, lower: int | None, upper: int | None) -> list[str]:
        if lower is None and upper is None:
            return list(state.chunks)
        known = [(self._start(c), c) for c in state.chunks if c != NO_CHUNK]
        return [c for at, c in sorted(known) if (upper is None or at < upper) and (lower is None or at > lower - self.width)]

    def read(self, lower: int | None = None, upper: int | None = None) -> DataFrame:
        """Rows of both tiers whose chunk overlaps [lower, upper) in internal time; only these chunks' folders are listed."""
        state = self.state()
        rows = self._both(self._overlapping(state, lower, upper), state)
        if upper is not None and self.space is None:
            rows = rows.filter(F.col(KEY) < upper)
        if lower is not None and self.space is None:
            rows = rows.filter(F.col(KEY) > lower - self.width)
        return rows

    def where(self, ranges: dict[str, tuple], lower: int | None = None, upper: int | None = None) -> DataFrame:
        """Rows in [lower, upper) whose columns lie in the given ranges (least, greatest; None is open).

        The ranges also become ranges of the batches' own least and greatest
        values and of their segments, which reach the scan of batches, so those
        that can't hold such a row are never unpacked.
        """
        state = self.state()
        kept, sure = dict(ranges), F.lit(True)
        if lower is not None or upper is not None:
            some = self._schema("rows", state) or self._rows_schema(state)
            low, high = time_range(some[self.time].dataType, lower, upper)
            kept[self.time] = (low, high)
            sure = (F.lit(True) if low is None else F.col(self.time) >= low) & (F.lit(True) if high is None else F.col(self.time) < high)
        rows = self._both(self._overlapping(state, lower, upper), state, kept)
        for column, (least, greatest) in ranges.items():
            c = F.col(f"`{column}`")
            sure = sure & (F.lit(True) if least is None else c >= least) & (F.lit(True) if greatest is None else c <= greatest)
        return rows.filter(sure)

    def _rows_schema(self, state: Manifest) -> StructType:
        return self._both([], state).schema

    # writing

    @contextmanager
    def change(self, log: bool = True) -> Iterator[ChunkedTable]:
        """A table to change: what is done to it counts at the end, all or nothing. log: whether rollups on it shall hear of it."""
        if self._work is not None:
            yield self
            return
        if self.generation is not None:
            raise ValueError("a snapshot can't be written")
        base = self.history.load()
        own = self.at(None)
        own._work = copy.deepcopy(base)
        yield own
        self.history.commit(base, own._work, own._touched if log else [])

    def create_like(self, other: ChunkedTable) -> None:
        """Makes an empty table with the other's columns and compression settings."""
        with self.change() as table:
            kept = other.state()
            table._work.schemas, table._work.settings = copy.deepcopy(kept.schemas), copy.deepcopy(kept.settings)

    def configure(self, segment_by: list[str], order_by: list, version: int = FORMAT) -> None:
        with self.change() as table:
            table._work.settings = {"version": version, "segment_by": list(segment_by), "order_by": [list(o) for o in triples(order_by)]}

    def _write(self, frame: DataFrame, tier: str, rows: Column | None = None, chunk: str | None = None) -> dict[str, list[dict]]:
        """Writes keyed rows or batches to folders of their own: pieces by chunk. The write observes its numbers where there is one chunk."""
        version = f"v{uuid.uuid4().hex}"
        folder, schema = f"{self.path}/{tier}/{_VERSION}={version}", StructType([f for f in frame.schema if f.name != KEY])
        kept, own = self._work.schemas.get(tier), _nullable(json.loads(schema.json()))
        fields = lambda x: {(f["name"], json.dumps(f["type"])) for f in x["fields"]}
        if kept is not None and fields(kept) != fields(own):
            raise ValueError(f"{self.path}: columns differ from those of the table")
        self._work.schemas.setdefault(tier, own)
        time = F.col(f"_min_{self.time}") if f"_min_{self.time}" in frame.columns else F.col(self.time) if self.time in frame.columns else F.lit(None)
        late = F.col(f"_max_{self.time}") if f"_max_{self.time}" in frame.columns else time
        measures = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.lit(1) if rows is None else rows), F.lit(0)).cast("long").alias("rows"), F.min(internal(time, self.kind)).alias("low"), F.max(internal(late, self.kind)).alias("high")]
        if chunk is not None:
            seen = Observation()
            frame.drop(KEY).observe(seen, *measures).write.parquet(f"{folder}/{KEY}={chunk}")
            found = {chunk: seen.get} if seen.get["n"] else {}
        else:
            frame.write.partitionBy(KEY).parquet(folder)
            back = self.spark.read.schema(StructType([*frame.schema.fields])).parquet(folder) if self.files.exists(folder) else frame.limit(0)
            found = {NO_CHUNK if r[KEY] is None else str(r[KEY]): r.asDict() for r in back.groupBy(KEY).agg(*measures).collect()}  # a row a chunk
        out = {}
        for name, seen_here in found.items():
            inner = f"{_VERSION}={version}/{KEY}={_HIVE_NULL if name == NO_CHUNK else name}"
            out[name] = [{"folder": inner, "n": seen_here["n"], "rows": seen_here["rows"], "bytes": self.files.size(f"{self.path}/{tier}/{inner}"), "low": seen_here["low"], "high": seen_here["high"]}]
        return out

    def _touch(self, *pieces: list[dict]) -> None:
        self._touched += [(p["low"], p["high"] + 1) for part in pieces for p in part if p["low"] is not None]

    def append(self, rows: DataFrame, log: bool = True) -> int:
        """Adds rows to the row tier; returns their number."""
        with self.change(log) as table:
            made = table._write(table._gathered(rows), "rows")
            for chunk, pieces in made.items():
                table._work.put(chunk, "rows", table._work.pieces(chunk, "rows") + pieces)
                table._touch(pieces)
        return sum(p["rows"] for pieces in made.values() for p in pieces)

    def replace(self, source: DataFrame, chunk: int | str, predicate: Column | None = None, log: bool = True) -> int:
        """Replace the rows of the chunk's row tier in the range by the source's; returns the rows it then has."""
        with self.change(log) as table:
            own, kept = table.keyed(source).filter(F.col(KEY) == table._key(chunk)), table.rows(chunk)
            new = replace_range(own.limit(0) if kept is None else kept.select(*own.columns), own, F.col(KEY) == table._key(chunk), predicate)
            made = table._write(new, "rows", chunk=str(chunk)).get(str(chunk), [])
            table._touch(table._work.pieces(str(chunk), "rows"), made)
            table._work.put(str(chunk), "rows", made)
        return sum(p["rows"] for p in made)

    def replace_batches(self, batches: DataFrame, chunk: int | str, log: bool = True) -> int:
        """Makes batches the compressed tier of one chunk, and drops its old one; returns their number."""
        with self.change(log) as table:
            made = table._write(batches.withColumn(KEY, table._key(chunk)), "batches", F.col("_count"), str(chunk)).get(str(chunk), [])
            table._touch(table._work.pieces(str(chunk), "batches"), made)
            table._work.put(str(chunk), "batches", made)
        return sum(p["n"] for p in made)

    def append_batches(self, batches: DataFrame, chunk: int | str, log: bool = True) -> int:
        """Adds batches of one chunk to what it has, or makes its compressed tier; returns the number added."""
        with self.change(log) as table:
            made = table._write(batches.withColumn(KEY, table._key(chunk)), "batches", F.col("_count"), str(chunk)).get(str(chunk), [])
            table._touch(made)
            table._work.put(str(chunk), "batches", table._work.pieces(str(chunk), "batches") + made)
        return sum(p["n"] for p in made)

    def compress_chunk(self, chunk: int | str, batch: int = BATCH) -> None:
        """Moves all rows of the chunk into batches; what the table holds stays the same, so nothing is logged."""
        with self.change(log=False) as table:
            rows, kept = table.content(chunk), table.settings()
            if kept["segment_by"] is None:
                raise ValueError(f"{self.path}: no compression settings")
            if rows is not None:
                table.replace_batches(compress(rows.drop(KEY), kept["segment_by"], [tuple(o) for o in kept["order_by"]], batch), chunk)
                table._work.put(str(chunk), "rows", [])
                table._touched.clear()

    def decompress_chunk(self, chunk: int | str) -> None:
        """Moves all batches of the chunk into rows."""
        with self.change(log=False) as table:
            if table.tiers(chunk)[1]:
                table._work.put(str(chunk), "rows", table._write(table.content(chunk), "rows", chunk=str(chunk)).get(str(chunk), []))
                table._work.put(str(chunk), "batches", [])

    def overwrite(self, rows: DataFrame, lower: int, upper: int, marks: dict | None = None, log: bool = True) -> int:
        """Make rows the whole content, of both tiers, of all chunks that overlap [lower, upper); returns their count. marks: kept in the manifest by the same generation."""
        with self.change(log) as table:
            count = table.put_chunks(rows, table._overlapping(table._work, lower, upper))
            table._work.marks |= marks or {}
        return count

    def put_chunks(self, rows: DataFrame, chunks: list[int | str], log: bool = True) -> int:
        """Make rows the whole content, of both tiers, of these chunks and of all that rows fall in; returns their count.

        Chunks that were compressed are compressed again.
        """
        with self.change(log) as table:
            made, known = table._write(table._gathered(rows), "rows"), {str(c) for c in chunks}
            packed = [c for c in {*known, *made} if table._work.pieces(c, "batches")]
            for chunk in {*known, *made}:
                table._touch(*[table._work.pieces(chunk, t) for t in TIERS], made.get(chunk, []))
                table._work.put(chunk, "batches", [])
                table._work.put(chunk, "rows", made.get(chunk, []))
            kept = list(table._touched)
            for chunk in packed:
                table.compress_chunk(chunk)
            table._touched = kept
        return sum(p["rows"] for pieces in made.values() for p in pieces)

    def touched_since(self, generation: int) -> list[tuple[int, int]]:
        """Ranges of time that logged writes touched after a generation, merged."""
        from tidemill.sources.manifest import merged

        return merged([(low, high) for at, low, high in self.state().log if at > generation])

    def clean(self) -> None:
        """Deletes folders that no generation names: what broken-off runs left behind."""
        self._drop({f for g in self.history.generations() for f in self.history.load(g).folders()})

    def vacuum(self, keep: int = 1) -> None:
        """Deletes all but the last generations and what only they name; frames and snapshots of these end."""
        self._drop(self.history.forget(keep))

    def _drop(self, needed: set[str]) -> None:
        for tier in TIERS:
            for version in self.files.names(f"{self.path}/{tier}"):
                chunks = self.files.names(f"{self.path}/{tier}/{version}")
                gone = [c for c in chunks if c.startswith(KEY) and f"{version}/{c}" not in needed]
                for chunk in gone:
                    self.files.delete(f"{self.path}/{tier}/{version}/{chunk}")
                if len(gone) == sum(c.startswith(KEY) for c in chunks):
                    self.files.delete(f"{self.path}/{tier}/{version}")


def generated_series(spark: SparkSession, start: str, end: str, step: str, devices: int) -> DataFrame:
    """(time, device_id): every step from start to end inclusive, for devices 1 to n."""
    times = spark.sql(f"SELECT explode(sequence(TIMESTAMP_NTZ'{start}', TIMESTAMP_NTZ'{end}', INTERVAL {step})) AS time")
    return times.select("time", F.explode(F.sequence(F.lit(1), F.lit(devices))).alias("device_id"))


def jdbc_table(spark: SparkSession, url: str, table: str, sslmode: str | None = "verify-full", predicates: list[str] | None = None, **options: str) -> DataFrame:
    """A table of another database, a partition for each predicate; certificates are verified unless told otherwise.

    Predicates that don't overlap, such as a chunk's range of times each, are
    pushed to the database one by one, so chunks are read side by side. sslmode
    None leaves it to the driver.
    """
    properties = ({} if sslmode is None else {"sslmode": sslmode}) | options
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties).load()

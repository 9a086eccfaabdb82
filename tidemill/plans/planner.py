"""Which chunks of which tables fall inside an interval, and with which residual filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.idents import matches, qualified, quote_ident, quote_literal
from tidemill.functions.times import INTEGER_TYPES, ORIGIN, bound_text, parse_bound
from tidemill.operators.rollups import Rollup
from tidemill.plans.catalog import first_dimension
from tidemill.sources.manifest import merged
from tidemill.sources.places import Files, written

#: Rows of one level of a hierarchy up to which they are sent to all tasks.
SEND_LEVEL = 100_000


def check_bound(spark: SparkSession, name: str, value: str) -> None:
    """ValueError unless the bound reads as a number or as a time; digits are taken for a number, all else for a time."""
    text = F.lit(value)
    row = spark.range(1).select(parse_bound(text, F.lit("bigint")), parse_bound(text, F.lit("timestamptz"))).first()
    if row[0] is None and row[1] is None:
        if value.strip().isdigit():
            raise ValueError(f"{name} is no valid bigint: {value}; tables with an integer time column need one, others a time")
        raise ValueError(f"{name} is no valid time: {value}; tables with a date or timestamp column need one, others an integer")


def plan_chunks(chunks: DataFrame, hypertables: DataFrame, dimensions: DataFrame, until: str, frm: str | None = None) -> DataFrame:
    """(hypertable, chunk_id, range_start, range_end, filter) of chunks that overlap [frm, until).

    chunks: (chunk_id, hypertable_id, range_start, range_end, dropped) by the
    time dimension. Chunks wholly inside carry no filter. A bound that can't be
    read for a dimension's type leaves that table out; ``skipped_tables`` names
    such tables.
    """
    upper, lower = parse_bound(F.lit(until), F.col("column_type")), F.lit(None).cast("bigint") if frm is None else parse_bound(F.lit(frm), F.col("column_type"))
    joined = (
        hypertables.withColumnRenamed("id", "hypertable_id")
        .join(first_dimension(dimensions).select("hypertable_id", "column_name", "column_type"), "hypertable_id")
        .withColumns({"_u": upper, "_l": lower})
        .join(chunks.filter(~F.col("dropped")), "hypertable_id")
        .filter(F.col("range_start") < F.col("_u"))
    )
    if frm is not None:
        joined = joined.filter(F.col("_l") < F.col("range_end"))
    literal = lambda bound: quote_literal(bound_text(F.col(bound), F.col("column_type")))  # noqa: E731  the value as read, not as typed
    above = F.when(F.col("_u") < F.col("range_end"), F.concat_ws(" < ", quote_ident(F.col("column_name")), literal("_u")))
    below = F.lit(None).cast("string") if frm is None else F.when(F.col("range_start") <= F.col("_l"), F.concat_ws(" >= ", quote_ident(F.col("column_name")), literal("_l")))
    return joined.select(qualified(F.col("schema_name"), F.col("table_name")).alias("hypertable"), "chunk_id", "range_start", "range_end", F.nullif(F.concat_ws(" and ", above, below), F.lit("")).alias("filter"))


def skipped_tables(hypertables: DataFrame, dimensions: DataFrame, until: str) -> DataFrame:
    """(hypertable, column_type) of tables whose time dimension can't be compared with the bound."""
    named = hypertables.withColumnRenamed("id", "hypertable_id").join(first_dimension(dimensions), "hypertable_id")
    return named.filter(parse_bound(F.lit(until), F.col("column_type")).isNull()).select(qualified(F.col("schema_name"), F.col("table_name")).alias("hypertable"), "column_type")


def seeds(hypertables: DataFrame, rollups: DataFrame, pattern: str | None) -> DataFrame:
    """(id) of tables that the pattern names, and of the storage of rollups whose view it names."""
    tables = hypertables.filter(matches(qualified(F.col("schema_name"), F.col("table_name")), pattern)).select("id")
    if pattern is None:
        return tables
    views = rollups.filter(matches(qualified(F.col("view_schema"), F.col("view_name")), pattern)).select(F.col("mat_id").alias("id"))
    return tables.union(views).distinct()


def _step(level: DataFrame, rows: int, edges: DataFrame, on: str) -> DataFrame:
    """The edges that leave a level. A small level is sent to all tasks, else both sides are shuffled; the hierarchy itself is never sent."""
    return (F.broadcast(level) if rows <= SEND_LEVEL else level).join(edges.hint("merge"), on)


def _walk(start: DataFrame, edges: DataFrame) -> DataFrame:
    """(id): start and all that edges (id, next) lead to from there, each once; one level after the other, staged."""
    level, path = written(start.distinct(), "walk")
    paths, rows = [path], level.count()
    read = start.sparkSession.read.schema(level.schema)
    while rows:
        found = _step(level, rows, edges, "id").select(F.col("next").alias("id")).distinct()
        # no anti join, which would be pushed below the step and shuffle all edges
        reached = read.parquet(*paths).select("id", F.lit(True).alias("_reached")).hint("merge")
        level, path = written(found.join(reached, "id", "left").filter("_reached is null").select("id"), "walk")
        paths.append(path)
        rows = level.count()
    return read.parquet(*paths)


def closure(start: DataFrame, rollups: DataFrame, up: bool, down: bool) -> DataFrame:
    """(id): start, all rollups built on it (up), all tables it is built on (down); directions don't mix."""
    if not up and not down:
        return start.distinct()
    kind = start.schema["id"].dataType
    edges, path = written(rollups.select(F.col("mat_id").cast(kind), F.col("raw_id").cast(kind)), "edges")
    out = start
    for wanted, own, other in ((up, "raw_id", "mat_id"), (down, "mat_id", "raw_id")):
        if wanted:
            out = out.union(_walk(start, edges.select(F.col(own).alias("id"), F.col(other).alias("next"))))
    Files(start.sparkSession, path).delete(path)  # the levels are written
    return out.distinct()


def levels(rollups: DataFrame) -> DataFrame:
    """(mat_id, view_schema, view_name, lvl): 0 for rollups of raw tables, one more for each step up. ValueError if the steps never end."""
    out = ["mat_id", "view_schema", "view_name"]
    edges, own_path = written(rollups.select("raw_id", *out), "edges")
    read = rollups.sparkSession.read.schema(edges.select(*out, F.lit(0).alias("lvl")).schema)
    built = edges.select(F.col("mat_id").alias("raw_id")).hint("merge")
    found = edges.filter("raw_id is not null").join(built, "raw_id", "left_anti")
    total, paths = edges.count(), []
    while True:
        level, path = written(found.select(*out, F.lit(len(paths)).alias("lvl")), "levels")
        paths.append(path)
        rows = level.count()
        if not rows:
            break
        if len(paths) > total:
            raise ValueError("the hierarchy of rollups has a cycle")
        found = _step(level.select(F.col("mat_id").alias("raw_id")), rows, edges, "raw_id")
    Files(rollups.sparkSession, own_path).delete(own_path)
    return read.parquet(*paths)


def refresh_plan(rollups: DataFrame, source_marks: DataFrame, target_marks: DataFrame) -> DataFrame:
    """(view_schema, view_name, lvl, column_type, window_start, window_end, start_text, end_text), a row a refresh in the order of levels, then of windows.

    From the target's watermark to the source's, where that lies later. Marks
    are (view_schema, view_name, column_type, watermark): views are told apart
    by schema and name, and both sides must have the same type of time. Texts
    are the bounds as that type reads them.
    """
    name = ["view_schema", "view_name"]
    s = source_marks.select(*name, "column_type", F.col("watermark").alias("window_end"))
    t = target_marks.select(*name, "column_type", F.col("watermark").alias("window_start"))
    planned = levels(rollups).join(t, name).join(s, [*name, "column_type"]).filter("window_start < window_end")
    text = lambda c: bound_text(F.col(c), F.col("column_type"))
    return planned.select(*name, "lvl", "column_type", "window_start", "window_end", text("window_start").alias("start_text"), text("window_end").alias("end_text")).orderBy("lvl", "window_start", *name)


def invalidated(touched: list[tuple[int, int]], rollup: Rollup, watermark: int, width: int) -> list[tuple[int, int]]:
    """Ranges of whole buckets below the watermark that touched times fall in; those of one chunk of the rollup's storage become one.

    What lies at or above the watermark isn't materialised: the next refresh
    up to the source's watermark computes it.
    """
    shift = 0 if rollup.kind in INTEGER_TYPES else ORIGIN % rollup.width
    down = lambda t: (t - shift) // rollup.width * rollup.width + shift
    cut = merged([(down(low), min(down(high - 1) + rollup.width, watermark)) for low, high in touched if low < watermark])
    out: list[tuple[int, int]] = []
    for low, high in cut:
        if out and out[-1][1] // width == low // width:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def overlapping(intervals: DataFrame, lower: int, upper: int) -> DataFrame:
    """Half-open intervals that share a point with [lower, upper)."""
    return intervals.filter((F.col("range_start") < upper) & (F.col("range_end") > lower))

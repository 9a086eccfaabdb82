"""Fingerprints of tables, chosen by column type, and their comparison.

Every column is counted; ordered types have a least and a greatest value;
exact numbers and day-time intervals have a sum. Sums are decimals, so that
they neither overflow nor round.
"""

from __future__ import annotations

import difflib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType)
_SUMMED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DayTimeIntervalType)
#: Sums may differ by this much a row.
TOLERANCE = 1.1920929e-07


def aggregates_of(field: T.StructField) -> list[str]:
    kinds = ["count"]
    if isinstance(field.dataType, _ORDERED):
        kinds += ["min", "max"]
    if isinstance(field.dataType, _SUMMED):
        kinds.append("sum")
    return kinds


def select_list(schema: T.StructType) -> list[tuple[str, str]]:
    """(aggregate, column) pairs in the order of kinds, then of columns."""
    return [(kind, f.name) for kind in ("min", "max", "sum", "count") for f in schema if kind in aggregates_of(f)]


def _aggregate(kind: str, field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if kind == "sum" and not isinstance(field.dataType, T.DayTimeIntervalType):
        scale = field.dataType.scale if isinstance(field.dataType, T.DecimalType) else 0
        return F.sum(column.cast(T.DecimalType(38, scale)))
    return {"count": F.count, "min": F.min, "max": F.max, "sum": F.sum}[kind](column)


def summary(frame: DataFrame, by: list[str] | None = None) -> DataFrame:
    """total_count and <kind>_<column> of a frame or of each group, in one pass with map-side aggregation."""
    schema = T.StructType([f for f in frame.schema if f.name not in (by or [])])
    fields = {f.name: f for f in schema}
    made = [_aggregate(kind, fields[name]).alias(f"{kind}_{name}") for kind, name in select_list(schema)]
    return frame.groupBy(*(by or [])).agg(F.count("*").alias("total_count"), *made)


def differing(schema: T.StructType, a: str, b: str) -> Column:
    """Whether two summaries differ: sums by tolerance, all else exactly. Null equals null."""
    out = ~F.col(f"{a}.total_count").eqNullSafe(F.col(f"{b}.total_count"))
    for kind, name in select_list(schema):
        x, y = F.col(f"{a}.`{kind}_{name}`"), F.col(f"{b}.`{kind}_{name}`")
        if kind == "sum" and not isinstance(schema[name].dataType, T.DayTimeIntervalType):
            near = F.abs(x - y).cast("double") <= TOLERANCE * F.col(f"{a}.`count_{name}`")
            out = out | ~F.coalesce(near, x.isNull() & y.isNull())
        else:
            out = out | ~x.eqNullSafe(y)
    return out


def verify_chunks(source: DataFrame, target: DataFrame, planned: DataFrame, key: str, details: bool = False) -> DataFrame:
    """(key, status) of planned chunks: source_missing, target_missing, mismatch or ok. One aggregation a side; details adds both summaries, s and t."""
    schema = T.StructType([f for f in source.schema if f.name != key])
    s, t = summary(source, [key]).alias("s"), summary(target, [key]).alias("t")
    joined = planned.select(key).alias("p").join(s, F.col(f"p.{key}") == F.col(f"s.{key}"), "left").join(t, F.col(f"p.{key}") == F.col(f"t.{key}"), "left")
    status = (
        F.when(F.col("s.total_count").isNull(), "source_missing")
        .when(F.col("t.total_count").isNull(), "target_missing")
        .when(differing(schema, "s", "t"), "mismatch")
        .otherwise("ok")
    )
    names = ["total_count", *[f"{kind}_{name}" for kind, name in select_list(schema)]]
    more = [F.struct(*[F.col(f"{side}.`{n}`") for n in names]).alias(side) for side in ("s", "t")] if details else []
    return joined.select(F.col(f"p.{key}").alias(key), status.alias("status"), *more)


def differing_parts(source: DataFrame, target: DataFrame, key: str, part: Column) -> DataFrame:
    """(key, part) of the parts of chunks whose fingerprints differ, a part missing on one side included. One aggregation a side."""
    names = [key, "_part"]
    schema = T.StructType([f for f in source.schema if f.name != key])
    s, t = (summary(side.withColumn("_part", part), names).alias(n) for side, n in ((source, "s"), (target, "t")))
    same = F.col(f"s.{key}").eqNullSafe(F.col(f"t.{key}")) & F.col("s._part").eqNullSafe(F.col("t._part"))
    wrong = s.join(t, same, "full_outer").filter(differing(schema, "s", "t"))
    return wrong.select(F.coalesce(f"s.{key}", f"t.{key}").alias(key), F.coalesce("s._part", "t._part").alias("part"))


def agree(schema: T.StructType, source: dict, target: dict) -> bool:
    """Whether two summaries agree by the rule of ``differing``: sums by tolerance, all else exactly."""
    if set(source) != set(target):
        return False
    for name in source:
        a, b = source[name], target[name]
        kind, _, column = name.partition("_")
        summed = kind == "sum" and column in schema.names and not isinstance(schema[column].dataType, T.DayTimeIntervalType)
        if summed and a is not None and b is not None:
            if abs(float(a - b)) > TOLERANCE * source[f"count_{column}"]:
                return False
        elif a != b and not (a != a and b != b):  # two NaN are equal, as in Spark
            return False
    return True


def render(row: dict) -> str:
    """A summary as text with stable order."""
    return "".join(f"{k}: {row[k]}\n" for k in sorted(row))


def difference_report(source: dict, target: dict) -> str:
    """Unified diff of two summaries, from source to target; empty if they agree as text."""
    return "".join(difflib.unified_diff(render(source).splitlines(True), render(target).splitlines(True), "source", "target"))

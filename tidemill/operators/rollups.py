"""Rollups by time bucket, hierarchies of them, and their incremental refresh."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from tidemill.functions.times import DAY, INTEGER_TYPES, ORIGIN, time_bucket

#: Moments that every bound is cut to: years 1 and 9999 in internal time.
EARLIEST, LATEST = -62_135_596_800_000_000, 253_402_300_799_000_000


@dataclass(frozen=True)
class Rollup:
    """bucket = time_bucket(width, time column), grouped by keys; aggregates as SQL, "max(x) AS y"."""

    name: str
    time: str
    width: int
    keys: tuple[str, ...]
    aggregates: tuple[str, ...]
    kind: str = "timestamp"

    def of(self, parent: DataFrame) -> DataFrame:
        bucket = time_bucket(F.col(self.time), self.width, self.kind).alias("bucket")
        return parent.filter(F.col(self.time).isNotNull()).groupBy(bucket, *self.keys).agg(*map(F.expr, self.aggregates))

    def watermark(self, materialised: DataFrame) -> DataFrame:
        """Exclusive end of the last bucket; no row for an empty rollup."""
        return materialised.agg((F.max("bucket") + self.width).alias("watermark")).filter("watermark is not null")


def refresh(rollup: Rollup, stored: DataFrame, parent: DataFrame, start: int, end: int) -> DataFrame:
    """stored with the buckets in [start, end) computed anew from the parent. Bounds must lie on bucket edges."""
    shift = 0 if rollup.kind in INTEGER_TYPES else ORIGIN % rollup.width
    if (start - shift) % rollup.width or (end - shift) % rollup.width:
        raise ValueError("refresh bounds must lie on bucket edges")
    inside = (F.col("bucket") >= start) & (F.col("bucket") < end)
    return stored.filter(~inside).unionByName(rollup.of(parent.filter(between(parent, rollup, start, end))))


def between(parent: DataFrame, rollup: Rollup, start: int, end: int) -> Column:
    """start <= time < end on the parent's own time column, so that it reaches the scan; bounds are bucket edges, as internal time."""
    return within(F.col(f"`{rollup.time}`"), parent.schema[rollup.time].dataType, start, end)


def within(time: Column, kind: DataType, start: int | None, end: int | None) -> Column:
    """start <= time < end for internal times; an end that is missing is open."""
    low, high = time_range(kind, start, end)
    return (F.lit(True) if low is None else time >= low) & (F.lit(True) if high is None else time < high)


def time_range(kind: DataType, start: int | None, end: int | None) -> tuple[Column | None, Column | None]:
    """(least, end) of [start, end) in internal time, as constants of a time column's own type, cut to what it can hold."""

    def constant(bound: int | None) -> Column | None:
        if bound is None:
            return None
        if isinstance(kind, DateType):  # a date is the midnight it begins with
            return F.date_from_unix_date(F.lit(min(max(-(-bound // DAY), EARLIEST // DAY), LATEST // DAY)).cast("int"))
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return F.timestamp_micros(F.lit(min(max(bound, EARLIEST), LATEST))).cast(kind)
        return F.lit(min(max(bound, -(2**63)), 2**63 - 1)).cast("bigint")

    return constant(start), constant(end)

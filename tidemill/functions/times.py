"""Internal time (microseconds since 1970, or plain integers), chunks and buckets. Sessions must run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR
#: Width of a chunk unless said otherwise.
CHUNK = 7 * DAY
#: Buckets of fixed width are aligned to Monday 2000-01-03, those of months to 2000-01-01.
ORIGIN = 946_857_600 * SECOND
INTEGER_TYPES = ("smallint", "integer", "bigint")
TIME_TYPES = ("timestamp", "timestamptz", "date")


def internal(column: Column, kind: str) -> Column:
    """A dimension value as internal bigint; null for types that can't be a dimension."""
    if kind in INTEGER_TYPES:
        return column.cast("bigint")
    if kind in TIME_TYPES:
        return F.unix_micros(column.cast("timestamp"))
    return F.lit(None).cast("bigint")


def from_internal(value: Column, kind: str) -> Column:
    moment = F.timestamp_micros(value)
    if kind == "timestamptz":
        return moment
    if kind == "timestamp":
        return moment.cast("timestamp_ntz")
    if kind == "date":
        return moment.cast("date")
    return value


def parse_bound(text: Column, kind: Column) -> Column:
    """A bound given as text, read by the dimension's type; integers must be digits only, else null."""
    digits = text.rlike("^[0-9]+$")
    moment = F.when(digits, F.try_to_timestamp(text, F.lit("yyyyMMdd"))).otherwise(text.try_cast("timestamp"))  # a bare year is no time
    number = F.when(digits, text.try_cast("bigint"))
    moment = F.when(kind == "date", F.date_trunc("day", moment)).otherwise(moment)
    return F.when(kind.isin(*INTEGER_TYPES), number).when(kind.isin(*TIME_TYPES), F.unix_micros(moment))


def bound_text(value: Column, kind: Column) -> Column:
    """An internal value as text that reads back as the dimension's type, however the bound was typed."""
    moment = F.timestamp_micros(value).cast("string")
    return (
        F.when(kind.isin(*INTEGER_TYPES), value.cast("string"))
        .when(kind == "date", F.substring(moment, 1, 10))
        .when(kind == "timestamptz", F.concat(moment, F.lit("+00")))
        .when(kind == "timestamp", moment)
    )


def floor_to(value: Column, width: int, origin: int = 0) -> Column:
    """The largest origin + k * width not above value; right for negative values too."""
    shifted = value - F.lit(origin)
    return value - F.pmod(shifted, F.lit(width).cast("bigint"))


def chunk_start(column: Column, kind: str = "timestamp", width: int = CHUNK) -> Column:
    return floor_to(internal(column, kind), width)


def time_bucket(column: Column, width: int, kind: str = "timestamp") -> Column:
    """Start of the bucket as internal time; integers are bucketed from 0."""
    return floor_to(internal(column, kind), width, 0 if kind in INTEGER_TYPES else ORIGIN % width)


def month_bucket(column: Column, months: int) -> Column:
    """First day of the bucket of so many months, as a date."""
    day = column.cast("date")
    index = (F.year(day) - 2000) * 12 + F.month(day) - 1
    return F.add_months(F.lit("2000-01-01").cast("date"), (index - F.pmod(index, F.lit(months))).cast("int"))


def space_slice(column: Column, parts: int) -> Column:
    """The slice of an integer space dimension: value modulo parts."""
    return F.pmod(column, F.lit(parts).cast("bigint"))


def hash_slice(column: Column, parts: int) -> Column:
    """The slice of a space dimension of any type: its 64-bit xxHash (seed 42) modulo parts; null is in slice 0."""
    return F.when(column.isNull(), F.lit(0).cast("bigint")).otherwise(F.pmod(F.xxhash64(column), F.lit(parts).cast("bigint")))

"""Row numbers over a whole table in any order, without a task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.sources.places import written

#: Rows of a range, about; the number of ranges follows the table.
RANGE_ROWS = 250_000
Order = list[tuple[str, bool, bool]]


def ordering(column: str, descending: bool, nulls_first: bool) -> Column:
    """All four orders, never the engine's default for nulls."""
    c = F.col(f"`{column}`")
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def numbered(rows: DataFrame, order: Order, number: str, ranges: int) -> DataFrame:
    """Adds the row number in the order: name, descending, nulls first. Rows that are equal in it are numbered as they come.

    Sampled splitters range-partition the rows by the order itself, each range
    is sorted and written once, so that ranges stay as they are; a row's place
    is then its place in the range after the counts of the ranges before. A
    frequent value is divided by the columns that follow it.
    """
    keys = [ordering(*o) for o in order]
    place = F.monotonically_increasing_id()  # the range's number above 33 bits, the place in it below
    placed, _ = written(rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("_place", place), "ranked")
    cell = F.shiftright("_place", 33)
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    counts = placed.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_n")).select("_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_cell", cell).join(F.broadcast(counts), "_cell").withColumn(number, F.col("_before") + inside + 1).drop("_cell", "_before", "_place")


def row_numbers(rows: DataFrame, orders: dict[str, Order], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds the row number in each order: name to (column, descending, nulls first)."""
    ranges = max(1, -(-rows.count() // range_rows))
    for number, order in orders.items():
        rows = numbered(rows, order, number, ranges)
    return rows

"""The columnar tier: batches of one segment's rows as arrays, with least and greatest values.

An order is a list of columns, each a name (ascending, nulls last) or a triple
(name, descending, nulls first). Rows are compressed chunk by chunk in a store;
``within`` names columns that divide segments further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ranking import numbered, ordering

BATCH = 1000
#: Rows of a segment above which it isn't ranked in one task.
HOT_ROWS = 1_000_000


def triples(order_by: list) -> list[tuple[str, bool, bool]]:
    return [(c, False, False) if isinstance(c, str) else tuple(c) for c in order_by]


def compress(rows: DataFrame, segment_by: list[str], order_by: list, batch: int = BATCH, within: tuple[str, ...] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row a batch: segment columns, _batch, _count, _min_/_max_ of each order column, and the rows in order as one array of structs.

    A segment of up to ``hot_rows`` rows is ranked by a window. Rows of larger
    ones are ranked over all tasks: range-partitioned by segment and order,
    numbered by ranges, less the number that their segment begins with.
    """
    order, keys = triples(order_by), [*segment_by, *within]
    window = Window.partitionBy(*keys).orderBy(*[ordering(*o) for o in order])
    by_window = lambda some: some.withColumn("_rank", F.row_number().over(window).cast("bigint"))
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    hot = large.collect() if keys else [r for r in large.collect() if r["_n"]]  # at most rows / hot_rows
    if not hot:
        ranked = by_window(rows)
    else:
        is_hot = F.lit(False)
        for row in hot:
            own = F.lit(True)
            for k in keys:
                own = own & F.col(f"`{k}`").eqNullSafe(F.lit(row[k]))
            is_hot = is_hot | own
        ranges = -(-sum(r["_n"] for r in hot) // hot_rows)
        made = numbered(rows.filter(is_hot), [*[(k, False, True) for k in keys], *order], "_number", max(2, ranges))
        first = made.groupBy(*keys).agg(F.min("_number").alias("_first"))  # a row a hot segment
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"m.`{k}`").eqNullSafe(F.col(f"f.`{k}`"))
        made = made.alias("m").join(F.broadcast(first).alias("f"), same)
        made = made.select(*[F.col(f"m.`{c}`") for c in rows.columns], (F.col("_number") - F.col("_first") + 1).alias("_rank"))
        ranked = by_window(rows.filter(~is_hot)).unionByName(made)
    return _batched(ranked, rows, keys, [c for c, _, _ in order], batch)


def _batched(ranked: DataFrame, rows: DataFrame, keys: list[str], names: list[str], batch: int) -> DataFrame:
    others = [F.col(f"`{c}`") for c in rows.columns if c not in keys]
    ranges = [f(F.col(f"`{c}`")).alias(f"_{name}_{c}") for c in names for name, f in (("min", F.min), ("max", F.max))]
    collected = F.collect_list(F.struct("_rank", F.struct(*others).alias("row")))
    if "map<" in rows.schema.simpleString() or "variant" in rows.schema.simpleString():  # these have no order
        ordered = F.array_sort(collected, lambda a, b: a["_rank"] - b["_rank"])
    else:
        ordered = F.sort_array(collected)
    grouped = ranked.withColumn("_batch", ((F.col("_rank") - 1) / batch).cast("bigint")).groupBy(*keys, "_batch")
    return grouped.agg(F.count("*").alias("_count"), *ranges, F.transform(ordered, lambda r: r["row"]).alias("_rows"))


def skipping(ranges: dict[str, tuple], batches: DataFrame, segment_by: list[str]) -> Column:
    """What a batch must satisfy to hold a row whose columns lie in these ranges (least, greatest; None is open).

    A segment column has its value itself; a column of the order has the
    batch's least and greatest value; for others nothing is known.
    """
    out = F.lit(True)
    for column, (least, greatest) in ranges.items():
        if column in segment_by:
            low = high = F.col(f"`{column}`")
        elif f"_min_{column}" in batches.columns:
            low, high = F.col(f"`_min_{column}`"), F.col(f"`_max_{column}`")
        else:
            continue
        out = out if least is None else out & (high >= least)
        out = out if greatest is None else out & (low <= greatest)
    return out


def decompress(batches: DataFrame, columns: list[str], predicate: Column | None = None) -> DataFrame:
    """The rows of the batches in the given column order; predicate prunes batches by their ranges first."""
    kept = batches if predicate is None else batches.filter(predicate)
    flat = kept.select("*", F.inline("_rows"))
    return flat.select(*columns)


def all_tiers(row_tier: DataFrame, batches: DataFrame) -> DataFrame:
    """Rows of both tiers of a partially compressed chunk."""
    return row_tier.unionByName(decompress(batches, row_tier.columns))


def assert_same_settings(table: str, source: dict, target: dict) -> None:
    """ValueError, with what to do, unless both sides compress a table alike and have one format."""
    if source["version"] != target["version"]:
        raise ValueError(f"{table}: the source has format {source['version']}, the target {target['version']}: bring both to one version first")
    if source["segment_by"] is not None and source != target:
        shown = lambda s: "none" if s["segment_by"] is None else f"segment by {s['segment_by']}, order by {s['order_by']}"
        raise ValueError(f"{table}: compression settings differ (source: {shown(source)}; target: {shown(target)}): decompress the target's chunks, configure it like the source, and stage again")


def settings_differ(a: str, b: str) -> Column:
    """Whether two structs of compression settings differ; null equals null."""
    return ~F.col(a).eqNullSafe(F.col(b))

"""Range deletion and replacement: the target keeps what lies outside the range and takes the source's rows within."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _certain(predicate: Column | None) -> Column:
    return F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))


def range_delete(target: DataFrame, predicate: Column | None) -> DataFrame:
    """Rows that survive a deletion: only those where the predicate is true go."""
    return target.filter(~_certain(predicate))


def replace_range(target: DataFrame, source: DataFrame, chunk: Column, predicate: Column | None = None) -> DataFrame:
    """Target without the chunk's rows in the range, and the source's rows there.

    The deletion is always bound to the chunk and the range, so nothing of a
    neighbouring chunk is touched, and doing it twice equals doing it once.
    """
    within = _certain(chunk) & _certain(predicate)
    return target.filter(~within).unionByName(source.filter(within))


def route(filtered: bool, source_compressed: bool, target_compressed: bool, target_partial: bool, source_has_rows: bool) -> list[str]:
    """The steps that copy one chunk, by the state of both sides; ``Migration.copy_one`` does them in this order."""
    if filtered and source_compressed:
        steps = ["decompress target"] if target_compressed else []
        return [*steps, "replace range from both tiers", *(["compress target"] if target_compressed else [])]
    if not source_compressed:
        return [*(["decompress target"] if target_compressed else []), "replace range of the row tier"]
    through_root = target_compressed and not target_partial and source_has_rows
    row_step = "write rows through the table" if through_root else "replace range of the row tier"
    return [row_step, "append compressed batches" if target_compressed else "create compressed chunk with batches"]


def upsert_arrays(stored: DataFrame, new: DataFrame) -> DataFrame:
    """(key, value) with JSON arrays as values: those of keys that are there get the new elements at their end."""
    old, own = F.col("s.value"), F.col("n.value")
    joined = F.when(old == "[]", own).when(own == "[]", old).otherwise(F.concat(F.substring(old, F.lit(1), F.length(old) - 1), F.lit(","), F.substring(own, F.lit(2), F.length(own))))
    both = stored.alias("s").join(new.alias("n"), F.col("s.key") == F.col("n.key"), "full_outer")
    return both.select(F.coalesce("s.key", "n.key").alias("key"), F.coalesce(joined, old, own).alias("value"))

"""The catalogue as small frames: hypertables, dimensions, slices, chunks, rollups.

The catalogue has one row a chunk, so it stays small next to the data; the
joins below are inner equi-joins that the optimiser may broadcast by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_dimension(dimensions: DataFrame) -> DataFrame:
    """The dimension of least id of each hypertable: its time dimension. Combined before the shuffle, so many rows of one table do no harm."""
    one = F.min_by(F.struct(*[F.col(f"`{c}`") for c in dimensions.columns]), "id").alias("_one")
    return dimensions.groupBy("hypertable_id").agg(one).select("_one.*")


def chunk_dimensions(constraints: DataFrame, slices: DataFrame, dimensions: DataFrame) -> DataFrame:
    """(chunk_id, dimensions): JSON array of a chunk's ranges in the order of dimension ids; identity across databases."""
    joined = constraints.join(slices.withColumnRenamed("id", "slice_id"), "slice_id").join(dimensions.select(F.col("id").alias("dimension_id"), "column_name", "column_type"), "dimension_id")
    ranges = F.array_sort(F.collect_list(F.struct("dimension_id", "column_name", "column_type", "range_start", "range_end")))
    bare = F.transform(ranges, lambda x: F.struct(x["column_name"].alias("column_name"), x["column_type"].alias("column_type"), x["range_start"].alias("range_start"), x["range_end"].alias("range_end")))
    return joined.groupBy("chunk_id").agg(F.to_json(bare, {"ignoreNullFields": "false"}).alias("dimensions"))


def match_chunks(source: DataFrame, target: DataFrame) -> DataFrame:
    """(source_chunk, target_chunk) where the target has an equal slice for every dimension of the source.

    Both sides: (chunk_id, table_name, column_name, column_type, range_start,
    range_end), one row a dimension. A target with more dimensions still matches.
    """
    wanted = source.groupBy("chunk_id").agg(F.count("*").alias("_wanted"))
    keys = ["table_name", "column_name", "column_type", "range_start", "range_end"]
    s, t = source.select(F.col("chunk_id").alias("source_chunk"), *keys), target.select(F.col("chunk_id").alias("target_chunk"), *keys)
    found = s.join(t, keys).groupBy("source_chunk", "target_chunk").agg(F.countDistinct("column_name", "range_start").alias("_found"))
    return found.join(wanted, found.source_chunk == wanted.chunk_id).filter("_found = _wanted").select("source_chunk", "target_chunk")


def missing_chunks(source: DataFrame, matched: DataFrame) -> DataFrame:
    """(chunk_id) of source chunks that have no counterpart and must be created."""
    return source.select("chunk_id").distinct().join(matched.select(F.col("source_chunk").alias("chunk_id")), "chunk_id", "left_anti")


def json_records(text: DataFrame, column: str, schema: str) -> DataFrame:
    """The rows of a JSON array of objects."""
    return text.select(F.inline(F.from_json(column, f"array<struct<{schema}>>")))


def with_existence(asked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Adds there: whether a chunk (hypertable_id, range_start) is in the catalogue and not dropped."""
    known = chunks.filter(~F.col("dropped")).select("hypertable_id", "range_start", F.lit(True).alias("there")).distinct()
    return asked.join(known, ["hypertable_id", "range_start"], "left").select("hypertable_id", "range_start", F.coalesce("there", F.lit(False)).alias("there"))

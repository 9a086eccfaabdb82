"""Schema signatures and their comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def signatures(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, type_name) from the frames' schemas."""
    rows = [(t, k + 1, f.name, f.dataType.simpleString()) for t, frame in tables.items() for k, f in enumerate(frame.schema)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, type_name string")


def ordered_columns(signature: DataFrame) -> DataFrame:
    """(table_name, columns): the ordered list of names and types; positions themselves don't count."""
    listed = F.array_sort(F.collect_list(F.struct("position", "column_name", "type_name")))
    text = F.array_join(F.transform(listed, lambda x: F.concat_ws(" ", x["column_name"], x["type_name"])), ", ")
    return signature.groupBy("table_name").agg(text.alias("columns"))


def mismatches(source: DataFrame, target: DataFrame) -> DataFrame:
    """(table_name, problem) of source tables that the target lacks or has with other columns."""
    s, t = ordered_columns(source).alias("s"), ordered_columns(target).alias("t")
    joined = s.join(t, F.col("s.table_name") == F.col("t.table_name"), "left")
    problem = F.when(F.col("t.columns").isNull(), "not found in target").otherwise("columns mismatch")
    wrong = F.col("t.columns").isNull() | (F.col("t.columns") != F.col("s.columns"))
    return joined.filter(wrong).select(F.col("s.table_name").alias("table_name"), problem.alias("problem"))


def foreign_key_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias("_pk")), F.col(child_key) == F.col("_pk"), "left_anti")


def assert_same_columns(source: DataFrame, target: DataFrame) -> None:
    """ValueError that names every table with a problem."""
    wrong = [f"{r.table_name}: {r.problem}" for r in mismatches(source, target).orderBy("table_name").collect()]
    if wrong:
        raise ValueError("source and target differ:\n" + "\n".join(wrong))

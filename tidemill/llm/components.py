"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, join_hot, staged

ROUNDS = 60


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(v, component) of edges (a, b) with long ends: component is the smallest vertex reached. What the result reads is the scratch's.

    Alternating large-star and small-star steps: the edges end as stars around
    the smallest vertices, after a number of rounds logarithmic in the longest
    path; it is over as soon as no vertex has two edges up, or edges up and
    down. Minima come from partial aggregates, and the minima of vertices with
    very many edges are sent to all tasks instead of gathering their edges.
    """
    spark = edges.sparkSession
    old = Scratch(spark)
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", old)
    for _ in range(ROUNDS):
        stars, count = _stars(edges)
        if stars:
            break
        now = Scratch(spark)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n")), "least", old)
        large = join_hot(both.filter("b > a"), least, ["a"], "n", 2 * count).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.filter("a <> b").distinct(), "large", old)
        least = staged(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least", old)
        small = join_hot(large, least, ["a"], "n", count).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(small.filter("a <> b").distinct(), "small", now)
        old.clear()
        old = now
    else:
        raise RuntimeError("components did not settle")
    if scratch is not None:
        scratch.paths += old.paths
    return edges.select(F.col("a").alias("v"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("v"), F.col("b").alias("component")).distinct())


def _stars(edges: DataFrame) -> tuple[bool, int]:
    """Whether each edge goes from a leaf to a centre, and the number of edges."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    by = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = by.agg(F.coalesce(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))), F.lit(False)).alias("other"), F.coalesce(F.sum("up"), F.lit(0)).alias("n")).first()
    return not row.other, row.n

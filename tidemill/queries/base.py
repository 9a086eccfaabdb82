"""Registration, input tables, and the catalogue that the queries share.

The catalogue is derived from the data on both sides: chunks of ``events`` and
``orders`` (by time), ``orders`` as an integer table, and four rollups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.times import CHUNK, DAY, chunk_start

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
YEAR = 365 * DAY
INT_WIDTH = 1000


def query(sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HYPERTABLES = [(1, "public", "events"), (2, "public", "orders"), (3, "other", "Orders Int"), (4, "internal", "mat_ev_6h"), (5, "internal", "mat_ev_24h"), (6, "internal", "mat_ev_2d"), (7, "internal", "mat_ord_month")]
_DIMENSIONS = [(1, 1, "ts", "timestamp"), (2, 1, "user_id", "bigint"), (3, 2, "o_orderdate", "timestamp"), (4, 3, "time", "bigint")]
_ROLLUPS = [(4, 1, "public", "ev_6h"), (5, 4, "public", "ev_24h"), (6, 5, "public", "ev_2d"), (7, 2, "other", "ord_month")]


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


#: The catalogue as common table expressions for the oracle.
CTE = f"""
    ht(id, schema_name, table_name) AS (VALUES {_values(_HYPERTABLES)}),
    dim(id, hypertable_id, column_name, column_type) AS (VALUES {_values(_DIMENSIONS)}),
    rollup_of(mat_id, raw_id, view_schema, view_name) AS (VALUES {_values(_ROLLUPS)}),
    ch AS (
        SELECT DISTINCT 1 AS hypertable_id, floor(epoch_us(ts) / {CHUNK}.0)::BIGINT * {CHUNK} AS range_start, {CHUNK} AS w FROM events WHERE ts IS NOT NULL
        UNION ALL SELECT DISTINCT 2, floor(epoch_us(o_orderdate) / {YEAR}.0)::BIGINT * {YEAR}, {YEAR} FROM orders WHERE o_orderdate IS NOT NULL
        UNION ALL SELECT DISTINCT 3, o_orderkey // {INT_WIDTH} * {INT_WIDTH}, {INT_WIDTH} FROM orders WHERE o_orderkey IS NOT NULL),
    chunks AS (SELECT hypertable_id, 'c' || hypertable_id || '_' || range_start AS chunk_id, range_start, range_start + w AS range_end,
                      (range_start // w) % 7 = 3 AS dropped FROM ch)"""


#: A hierarchy of rollups from the customers: number k is built on k // 2, and 0 is the raw table. With it, the tables.
TREE = """
    tree(mat_id, raw_id, view_schema, view_name) AS (SELECT c_custkey + 1, (c_custkey + 1) // 2, 'n' || c_nationkey, 'c' || c_custkey FROM customer WHERE c_custkey IS NOT NULL),
    stored(id, schema_name, table_name) AS (SELECT mat_id, 'internal', 'mat_' || mat_id FROM tree UNION ALL SELECT 0, 'public', 'raw')"""


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("c_custkey") + 1
    return table(spark, sf_dir, "customer").filter("c_custkey is not null").select(number.alias("mat_id"), F.floor(number / 2).cast("bigint").alias("raw_id"), F.concat(F.lit("n"), "c_nationkey").alias("view_schema"), F.concat(F.lit("c"), "c_custkey").alias("view_name"))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = tree(spark, sf_dir).select(F.col("mat_id").alias("id"), F.lit("internal").alias("schema_name"), F.concat(F.lit("mat_"), "mat_id").alias("table_name"))
    return own.unionByName(spark.createDataFrame([(0, "public", "raw")], "id long, schema_name string, table_name string"))


def hypertables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_HYPERTABLES, "id int, schema_name string, table_name string")


def dimensions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_DIMENSIONS, "id int, hypertable_id int, column_name string, column_type string")


def rollups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_ROLLUPS, "mat_id int, raw_id int, view_schema string, view_name string")


def chunks(spark: SparkSession, sf_dir: str, drop: bool = True) -> DataFrame:
    """(hypertable_id, chunk_id, range_start, range_end, dropped); one row a chunk."""
    out = None
    for number, name, column, kind, width in ((1, "events", "ts", "timestamp", CHUNK), (2, "orders", "o_orderdate", "timestamp", YEAR), (3, "orders", "o_orderkey", "bigint", INT_WIDTH)):
        rows = table(spark, sf_dir, name).filter(F.col(column).isNotNull())
        own = rows.select(F.lit(number).alias("hypertable_id"), chunk_start(F.col(column), kind, width).alias("range_start")).distinct().withColumn("w", F.lit(width).cast("bigint"))
        out = own if out is None else out.unionByName(own)
    dropped = (F.col("range_start") / F.col("w")).cast("bigint") % 7 == 3 if drop else F.lit(False)
    return out.select("hypertable_id", F.concat(F.lit("c"), "hypertable_id", F.lit("_"), "range_start").alias("chunk_id"), "range_start", (F.col("range_start") + F.col("w")).alias("range_end"), dropped.alias("dropped"))

"""Statistics of chunked tables in the metastore, so that the optimiser knows rows and values before it plans a join.

The row tier of a table becomes an external table of the metastore, and the
compressed tier another with ``_batches`` after its name; each piece that the
manifest names is a partition (_v, _chunk) at its own folder. Registering again
adds and drops just the partitions that changed. Data stays where it is:
dropping the metastore's table or a partition deletes no file.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemill.sources.manifest import TIERS
from tidemill.sources.store import _HIVE_NULL, _VERSION, KEY, ChunkedTable

#: Partitions that one statement adds or drops.
TOGETHER = 500
_GENERATION = "tidemill.generation"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _full(name: str, tier: str) -> str:
    return ".".join(map(ident, f"{name}{'' if tier == 'rows' else '_batches'}".split(".", 1)))


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _partition(folder: str) -> str:
    version, chunk = (part.split("=", 1)[1] for part in folder.split("/"))
    return f"PARTITION ({_VERSION} = '{version}', {KEY} = {'NULL' if chunk == _HIVE_NULL else f"'{chunk}'"})"


def register(table: ChunkedTable, name: str) -> list[str]:
    """Makes the metastore's tables name and name_batches of what the table holds now; returns those that there are.

    name: a table, or a database and a table. A name that stands for another folder is an error.
    """
    spark, state, made = table.spark, table.state(), []
    for tier in TIERS:
        schema = table._schema(tier, state)
        if schema is None:
            continue
        full = _full(name, tier)
        folder = table.files.full(f"{table.path}/{tier}")
        columns = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}, {_VERSION} string, {KEY} {table.key_type.replace('long', 'bigint')}) USING parquet PARTITIONED BY ({_VERSION}, {KEY}) LOCATION '{folder}'")
        if table.files.full(_described(spark, full)["Location"]) != folder:
            raise ValueError(f"{full} is the name of another table")
        there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}  # a row a piece, like the manifest
        wanted = {p["folder"] for c in state.chunks for p in state.pieces(c, tier)}
        for action, folders in (("DROP IF EXISTS", sorted(there - wanted)), ("ADD IF NOT EXISTS", sorted(wanted - there))):
            for at in range(0, len(folders), TOGETHER):
                some = folders[at : at + TOGETHER]
                if action.startswith("ADD"):
                    spark.sql(f"ALTER TABLE {full} {action} " + " ".join(f"{_partition(f)} LOCATION '{folder}/{f}'" for f in some))
                else:
                    spark.sql(f"ALTER TABLE {full} {action} " + ", ".join(map(_partition, some)))
        made.append(full)
    return made


def analyze(table: ChunkedTable, name: str, columns: list[str] | None = None) -> list[str]:
    """Registers the table and has Spark count its rows, and describe the named columns (least, greatest, nulls, distinct).

    Rows are counted from the files' footers; only named columns are read.
    Nothing is done to a table whose generation was analysed before. Returns
    the names that were analysed. An empty tier has 0 rows.
    """
    spark, generation, out = table.spark, str(table.state().generation), []
    mark = f"{generation}:{','.join(columns or [])}"
    for full in register(table, name):
        known = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
        if known.get(_GENERATION) == mark:
            continue
        there = set(spark.table(full).columns)
        chosen = [ident(c) for c in columns or [] if c in there]
        spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS" + (f" FOR COLUMNS {', '.join(chosen)}" if chosen else ""))
        spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('{_GENERATION}' = '{mark}')")
        out.append(full)
    return out


def row_count(spark: SparkSession, full: str) -> int | None:
    """Rows of a table as the metastore has them; None where it wasn't analysed."""
    text = _described(spark, full).get("Statistics", "")
    return int(text.split(",")[1].split()[0]) if "rows" in text else None


def column_statistics(spark: SparkSession, full: str, column: str) -> dict[str, str | None]:
    """min, max, num_nulls, distinct_count and more of a column, as texts."""
    found = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full} {ident(column)}").collect()}
    return {k: None if v == "NULL" else v for k, v in found.items()}


def drop(table: ChunkedTable, name: str) -> None:
    """Forgets the metastore's tables; files stay."""
    for tier in TIERS:
        table.spark.sql(f"DROP TABLE IF EXISTS {_full(name, tier)}")

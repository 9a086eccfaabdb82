"""What the operators of this subpackage share: inputs, staging, Arrow mapping.

Conventions that hold for every operator here, unless its docstring says more:

* an operator selects the columns it needs first, so extra columns, whatever
  their names, neither clash nor reach its result;
* a null text counts as the empty text;
* a null ``doc_id`` is kept as null and is hashed as the empty string;
* repeated rows give repeated result rows;
* an empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as in the contracts' ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"

_own_dirs: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(doc_id long, text string not null) and the named further columns."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *[F.col(c) for c in more],
    )


def id_crc(column: Column | None = None) -> Column:
    """crc32 of the id as text; a null id counts as the empty string."""
    column = F.col("doc_id") if column is None else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def held_out(modulus: int, remainder: int, column: Column | None = None) -> Column:
    """True for rows that training must not see."""
    return id_crc(column) % modulus == remainder


def hash_share(share: float, column: Column | None = None) -> Column:
    """True for about this share of ids (or names), the same ones each time: those of least hash."""
    column = F.col("doc_id").cast("string") if column is None else column
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(column) < F.lit(int(share * 2**64) - 2**63)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a local master may go without that setting; it then gets a folder of
    its own. On a cluster a machine-local folder would lose data, so its
    absence is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = context.applicationId
    if key not in _own_dirs:
        made = tempfile.mkdtemp(prefix="tidemill-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _own_dirs[key] = f"file://{made}"
    return _own_dirs[key]


def staged(frame: DataFrame, tag: str, scratch: Scratch | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    if scratch is not None:
        scratch.paths.append(path)
    return spark.read.schema(frame.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder of a store that Spark can reach."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Staged folders that are deleted once what was built from them has been written itself.

    Only folders that no frame in use reads may be given up; what a lazy
    result still reads stays in the shared folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def clear(self) -> None:
        for path in self.paths:
            delete(self.spark, path)
        self.paths.clear()


#: A key with at least this part of all rows is hot; so there are at most its inverse of them.
HOT_PART = 1 / 1000
#: Rows below which no key is hot.
HOT_ROWS = 1000


def join_hot(frame: DataFrame, table: DataFrame, on: list[str], weight: str, total: int, hot_part: float = HOT_PART, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of frame with a staged table of one row a key, where some keys may have very many rows in frame.

    ``weight`` is the table's column with at most as many rows as frame has of
    that key, and ``total`` their sum. The few hot keys (at most 1 / hot_part)
    are sent to all tasks; the rows of all others are shuffled.
    """
    least = max(hot_rows, int(total * hot_part))
    hot, cold = table.filter(F.col(weight) >= least), table.filter(F.col(weight) < least)
    rest = frame.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return frame.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))


def confirm_names(bodies: DataFrame) -> None:
    """RuntimeError if some name stands for two different bodies (name binary, body binary), compared in full.

    Least and greatest body come from partial aggregates, so a common name is
    never gathered.
    """
    clash = bodies.groupBy("name").agg(F.min("body").alias("a"), F.max("body").alias("b")).filter("a <> b")
    if not clash.isEmpty():
        raise RuntimeError("two different texts have the same SHA-256")


def fresh(frame: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that the frame doesn't have, whatever their case."""
    have = {c.lower() for c in frame.columns}
    out = []
    for name in wanted:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, text: int, rows: int = 512, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most so many rows and about so many bytes in column ``text``; a long text comes alone."""
    sizes = pc.binary_length(batch.column(text).cast(pa.large_binary())).fill_null(0).to_pylist()
    start = held = 0
    for k, n in enumerate(sizes):
        if k > start and (k - start >= rows or held + n > size):
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow side of a flat DDL string such as "doc_id long, text string"; works on executors too."""
    names = [part.strip().rsplit(" ", 1) for part in ddl.split(",")]
    return pa.schema([(name.strip("`"), _ARROW[kind]) for name, kind in names])


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def map_rows(frame: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], ddl: str, slice_rows: int = 1024, text: int | None = None) -> DataFrame:
    """mapInArrow in slices of bounded rows, and of bounded bytes of the column numbered ``text``.

    ``make`` runs once per task on the executor and returns the function that
    turns a slice into columns by name; tables such as vocabularies load there.
    """
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in batches:
            parts = (batch.slice(k, slice_rows) for k in range(0, batch.num_rows, slice_rows)) if text is None else slices(batch, text, slice_rows)
            for part in parts:
                function = function or make()
                out = function(part)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return frame.mapInArrow(run, ddl)


class WordCache(dict):
    """A memo for one function of a string, of bounded memory.

    It starts over once keys and values hold about ``limit`` bytes; keys longer
    than ``longest`` are computed each time and never kept.
    """

    def __init__(self, function: Callable[[str], object], limit: int = 64 << 20, longest: int = 64):
        super().__init__()
        self.function, self.limit, self.longest, self.held = function, limit, longest, 0

    def __missing__(self, key: str) -> object:
        value = self.function(key)
        if len(key) <= self.longest:
            self.held += 200 + 2 * len(key) + (len(value) if isinstance(value, bytes) else 64)
            if self.held > self.limit:
                self.clear()
                self.held = 0
            self[key] = value
        return value

"""Operator 8, exact deduplication by content sort.

Texts are equal when they agree after every run of ASCII white space became
one space. Each task first merges equal texts within blocks of bounded size,
so that a text with very many copies goes out once per block, as a carrier.
A text with very many carriers is merged once more, in about as many salted
groups as each has carriers. Then sampled splitters range-partition the
normalised bytes, an external sort puts equal texts side by side, and each is
compared in full with its neighbour; the smallest identifier of a run stays.

The sort key is the beginning of the normalised text, then its SHA-256, then
the whole text: documents that merely begin alike spread over many ranges,
splitters stay small however long the texts are, and equality is always
decided on the whole text.

Defined results: a null text counts as empty, and all empty texts are one
group; a null doc_id comes after all others and never stays unless its group
has no other; repeated rows (same doc_id, same text) each return a row, count
in group_size, and share ``kept``; where one row is to stay of several with the
same doc_id and equal normalised texts, it is the one of least text as it is;
very long texts are compared whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, arrow_schema, documents, fresh, id_and_text, record_batch, staged

#: A block of texts that one task merges: at most so many bytes and rows.
BLOCK_BYTES, BLOCK_ROWS = 32 << 20, 20_000
#: Bytes of normalised text that lead the sort key.
LEAD = 24
#: Bytes of text that one range should hold.
RANGE_BYTES = 64 << 20
#: A text is hot if it has more carriers than this, and than this part of all carriers; so there are few of them.
HOT_CARRIERS, HOT_PART = 64, 1 / 100_000

_runs = re.compile(r"[\t-\r][ \t-\r]*| [ \t-\r]+")

_BLOCKS = "doc_id long, carrier_id long, sha binary, copies long, n_bytes long, lead binary, body binary"
_HEADS = "carrier_id long, sha binary, keep_id long, group_size long"


def normalised(text: str) -> bytes:
    return _runs.sub(" ", text).encode()


def _merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and one with the whole text for each different text of a block.

    carrier_id, the smallest id that the text has in the block, ties the two together.
    """
    schema = arrow_schema(_BLOCKS)
    block: dict[bytes, list] = {}
    held = rows = 0

    def flush() -> pa.RecordBatch:
        out: list[tuple] = []
        for body, ids in block.items():
            sha = hashlib.sha256(body).digest()
            known = [i for i in ids if i is not None]
            carrier = min(known) if known else None
            out += [(i, carrier, sha, None, None, None, None) for i in ids]
            out.append((None, carrier, sha, len(ids), len(body), body[:LEAD], body))
        return record_batch(out, schema)

    for batch in batches:
        ids = batch.column(0).to_pylist()
        for start in range(0, len(ids), 512):
            for doc_id, text in zip(ids[start : start + 512], batch.column(1).slice(start, 512).to_pylist(), strict=True):
                body = normalised(text)
                if body not in block:
                    block[body] = []
                    held += len(body)
                block[body].append(doc_id)
                rows += 1
                if held >= BLOCK_BYTES or rows >= BLOCK_ROWS:
                    yield flush()
                    block.clear()
                    held = rows = 0
    if block:
        yield flush()


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each sorted carrier. Of a run it holds one text and the carriers' ids, of which there is one a block."""
    schema = arrow_schema(_HEADS)
    body, sha, run, out = None, None, [], []

    def close() -> None:
        known = [c for c, _ in run if c is not None]
        keep, total = min(known) if known else None, sum(n for _, n in run)
        out.extend((c, sha, keep, total) for c, _ in run)

    def batch_of() -> pa.RecordBatch:
        made = record_batch(out, schema)
        out.clear()
        return made

    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            for new_body, new_sha, carrier, copies in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                if new_body != body:
                    if run:
                        close()
                    body, sha, run = new_body, new_sha, []
                run.append((carrier, copies))
            if len(out) >= 4096:
                yield batch_of()
    if run:
        close()
    if out:
        yield batch_of()


_MERGED = "carrier_id long, sha binary, top_id long, copies long, n_bytes long, lead binary, body binary"


def _merge_carriers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted carriers (sha, salt, body, carrier_id, copies): a row for each, and one with the text for each run of equal ones."""
    schema = arrow_schema(_MERGED)
    last, run = None, []

    def close() -> pa.RecordBatch:
        (sha, _, body), known = last, [c for c, _ in run if c is not None]
        top = min(known) if known else None
        return record_batch([(c, sha, top, None, None, None, None) for c, _ in run] + [(None, sha, top, sum(n for _, n in run), len(body), body[:LEAD], body)], schema)

    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            for sha, salt, body, carrier, copies in zip(*(part.column(k).to_pylist() for k in range(5)), strict=True):
                if (sha, salt, body) != last:
                    if run:
                        yield close()
                    last, run = (sha, salt, body), []
                run.append((carrier, copies))
    if run:
        yield close()


def _some(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(-(2**63)))


def equal_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_carriers: int = HOT_CARRIERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha binary): a row for each document."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    blocks = staged(id_and_text(docs, id_col, text_col).mapInArrow(_merge_blocks, _BLOCKS), "blocks")
    carriers, merged = blocks.filter(F.col("copies").isNotNull()), None
    total, count = carriers.agg(F.sum("n_bytes"), F.count("*")).first()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total or 0) // RANGE_BYTES)
    columns = ["body", "sha", "carrier_id", "copies", "lead"]
    hot = staged(carriers.groupBy("sha").agg(F.count("*").alias("c")).filter(F.col("c") > max(hot_carriers, count * HOT_PART)), "hot", scratch)  # at most 1 / HOT_PART rows
    if not hot.isEmpty():
        salted = carriers.join(F.broadcast(hot), "sha").withColumn("salt", F.pmod(F.xxhash64(_some("carrier_id")), F.ceil(F.sqrt("c"))))
        salted = salted.select("sha", "salt", "body", "carrier_id", "copies").repartition(ranges, "sha", "salt").sortWithinPartitions("sha", "salt", "body")
        merged = staged(salted.mapInArrow(_merge_carriers, _MERGED), "merged")
        tops = merged.filter("copies is not null").withColumn("carrier_id", F.col("top_id"))
        carriers = carriers.join(F.broadcast(hot), "sha", "left_anti").select(*columns).unionByName(tops.select(*columns))
    ordered = carriers.select(*columns).repartitionByRange(ranges, "lead", "sha").sortWithinPartitions("lead", "sha", "body").select(*columns[:-1])
    heads = staged(ordered.mapInArrow(_compare_neighbours, _HEADS), "heads")
    # a text has one carrier in each block, and a block's documents are few: no key is hot
    heads = heads.groupBy("sha", _some("carrier_id").alias("carrier")).agg(F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    if merged is not None:
        under = merged.filter("copies is null").select("sha", _some("carrier_id").alias("carrier"), _some("top_id").alias("top")).distinct()
        tops = under.join(heads.withColumnRenamed("carrier", "top"), ["sha", "top"]).select(*heads.columns)
        heads = heads.join(F.broadcast(hot_names(merged)), "sha", "left_anti").unionByName(tops)
    scratch.clear()
    members = blocks.filter(F.col("copies").isNull()).select("doc_id", _some("carrier_id").alias("carrier"), "sha")
    return members.join(heads, ["sha", "carrier"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "sha")


def hot_names(merged: DataFrame) -> DataFrame:
    """The hot texts' digests: at most 1 / HOT_PART."""
    return merged.filter("copies is not null").select("sha").distinct()


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns. Of repeated rows, one stays."""
    names = [F.col(f"`{n}`") for n in docs.columns]
    key_name, sha_name, row_name = fresh(docs, "copy_key", "copy_sha", "copy_row")
    key = lambda c: F.coalesce(c, F.lit(-(2**63)))  # noqa: E731  a plain key, so that one shuffle serves join and aggregate
    text = F.col(f"`{text_col}`").cast("string")
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", " ")
    stay = equal_groups(docs, id_col, text_col).filter("kept").select(key(F.col("doc_id")).alias(key_name), F.col("sha").alias(sha_name)).distinct()
    own = docs.withColumns({key_name: key(F.col(f"`{id_col}`").cast("long")), sha_name: F.unhex(F.sha2(body.cast("binary"), 256))})
    one = F.min_by(F.struct(*names), F.struct(text.isNull(), text)).alias(row_name)
    return own.join(stay, [key_name, sha_name], "left_semi").groupBy(key_name, sha_name).agg(one).select(f"{row_name}.*")


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


QUERIES = {"op8_exact": op8_exact}
ORACLE_SQL = {
    "op8_exact": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY body)"""
}

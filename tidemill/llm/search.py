"""Operator 11, ranked lexical search over compressed postings by Block-Max WAND.

The index is divided by documents: each task turns its texts into segments of
bounded size, so building one shuffles nothing, and a frequent term's postings
are spread over all segments. A term's postings in a segment are cut into blocks
of 128, each compressed by itself (gaps of places and frequencies in bytes of
seven bits). Beside a block stand its last place and its maximum impacts: the
pairs (frequency, length of document) that no other posting of the block beats.
The greatest score of a block under any corpus statistics is that of one of
them, so segments can be added later without touching old ones.

A search sends a bounded block of queries to all segments. In a segment, a
query's pointers are first moved over its lists' block edges only (shallow
moves): between two edges every list stands in one block, and the sum of these
blocks' maxima bounds every document there. Stretches are taken from the
greatest bound on; only their blocks are decompressed, and as soon as the tenth
best score is above a stretch's bound, it and all after it are skipped. The best
documents of all segments are ranked at last.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII,
only A to Z lower-cased. Scores are integers as ``impact`` and ``with_weights``
say.

Defined results: null and empty texts have no term and aren't counted; repeated
rows are documents of their own, and so are very long texts, which are read
whole; equal scores go by ascending doc_id, a null doc_id last; query rows that
share an id are one query; a query without known terms has no row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, arrow_schema, delete, documents, id_and_text, map_rows, record_batch, shared_dir, slices, staged

TOP = 10
#: Postings of a block.
BLOCK = 128
#: A segment's bytes of text and documents, at most about.
SEGMENT_BYTES, SEGMENT_DOCS = 16 << 20, 1 << 16
#: Pairs of query and term that are sent to all tasks at once, about.
QUERY_PAIRS = 50_000
#: Stretches between block edges that are opened first; then twice as many each time.
FIRST_STRETCHES = 8

_IN_TERM = bytes(b for b in range(256) if chr(b).isalnum() and b < 128 or b >= 128)
_TABLE = bytes((b | 32 if 65 <= b <= 90 else b) if b in _IN_TERM else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_TABLE).split()


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each value's bytes): seven bits a byte, the lowest first; the last byte of a value has no high bit."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        more = values >> bits > 0
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts, left = ends - sizes, np.arange(len(values))
    for k in range(int(sizes.max(initial=0))):
        left = left[sizes[left] > k]
        out[starts[left] + k] = (values[left] >> 7 * k & 127) | np.where(sizes[left] > k + 1, 128, 0)
    return out, ends


def unpack(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    if not len(ends):
        return ends
    starts = np.concatenate(([0], ends[:-1] + 1))
    within = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * within, starts)


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The values cut at these places (the end included), as a column of bytes."""
    values = np.ascontiguousarray(values)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((starts * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


_POSTINGS = "segment long, term string, n long, total long, lasts binary, ends binary, tops binary, payload binary"


class Segment:
    """Collects documents and writes them as rows: one without a term for the documents, one for each term.

    The row of documents: n and total (documents and their terms), lasts
    (lengths, int64), payload (ids, int64), ends (a byte each, 0 for a null id).
    A term's row: n (documents), lasts and ends (of each block: last place, end
    of its bytes; int32), tops (block, frequency, length: int64 triples).
    """

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.held = 0

    def add(self, ids: list, texts: list[bytes]) -> None:
        words: list[bytes] = []
        for doc_id, text in zip(ids, texts, strict=True):
            own = terms_of(text)
            if own:
                self.ids.append(doc_id)
                self.lengths.append(len(own))
                words += own
            self.held += len(text)
        number, known = self.terms.setdefault, self.terms
        self.codes.append(np.fromiter([number(w, len(known)) for w in words], np.int32, len(words)))

    def rows(self, segment: int) -> Iterator[pa.RecordBatch]:
        schema, n = arrow_schema(_POSTINGS), len(self.ids)
        if not n:
            return
        lengths = np.array(self.lengths, np.int64)
        ids, there = np.array([i or 0 for i in self.ids], "<i8"), np.array([i is not None for i in self.ids], np.uint8)
        yield record_batch([(segment, None, n, int(lengths.sum()), lengths.tobytes(), there.tobytes(), None, ids.tobytes())], schema)
        pairs = np.sort(np.concatenate(self.codes).astype(np.int64) * n + np.repeat(np.arange(n), lengths))
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        tf = np.diff(np.append(first, len(pairs)))
        term, doc = np.divmod(pairs[first], n)
        lists = np.flatnonzero(np.diff(term, prepend=-1))  # each term has at least one posting
        begins = np.append(lists, len(doc))
        place = np.arange(len(doc)) - np.repeat(lists, np.diff(begins))
        gaps = np.diff(doc, prepend=-1)
        gaps[lists] = doc[lists] + 1
        data, ends = pack(np.stack((gaps, tf), 1).ravel())
        opens = np.flatnonzero(place % BLOCK == 0)
        block = np.cumsum(place % BLOCK == 0) - 1
        closes = np.append(opens[1:], len(doc)) - 1
        first_block, blocks = block[lists], np.append(block[lists], len(opens))
        byte_ends = ends[2 * closes + 1]
        list_bytes = np.append(np.concatenate(([0], ends))[2 * lists], len(data))
        base = np.repeat(list_bytes[:-1], np.diff(blocks))
        # of a block's postings in the order of lengths, those of a frequency that no shorter document has
        rank = np.unique(lengths, return_inverse=True)[1]
        order = np.argsort(block << 16 | rank[doc], kind="stable")
        level = block[order] * (int(tf.max()) + 1) + tf[order]
        top = order[np.diff(np.maximum.accumulate(level), prepend=-1) > 0]
        top_starts = np.searchsorted(block[top], blocks)
        inner = block[top] - first_block[term_index(term, lists)[top]]
        tops = np.stack((inner, tf[top], lengths[doc[top]]), 1).ravel()
        names = [b"" for _ in self.terms]
        for word, k in self.terms.items():
            names[k] = word
        size = 4096
        for a in range(0, len(lists), size):
            b = min(a + size, len(lists))
            part = lambda values, starts: _binary(values[starts[a] : starts[b]], starts[a : b + 1] - starts[a])  # noqa: B023, E731
            columns = [
                pa.array(np.full(b - a, segment)), pa.array([w.decode() for w in names[a:b]]), pa.array(np.diff(begins)[a:b]), pa.nulls(b - a, pa.int64()),
                part(doc[closes].astype("<i4"), blocks), part((byte_ends - base).astype("<i4"), blocks), part(tops.astype("<i8"), top_starts * 3), part(data, list_bytes),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def term_index(term: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """The number of each posting's list."""
    return np.repeat(np.arange(len(lists)), np.diff(np.append(lists, len(term))))


def postings(docs: DataFrame, batch: int = 0, segment_bytes: int = SEGMENT_BYTES, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The rows of the segments of (doc_id, text); batch numbers them apart from those of other calls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = Segment(), (batch << 48) + (TaskContext.get().partitionId() << 20)
        for rows in batches:
            for part in slices(rows, 1, segment_docs):
                texts = [t.encode() for t in part.column(1).to_pylist()]
                if own.held and (own.held + sum(map(len, texts)) > segment_bytes or len(own.ids) + len(texts) > segment_docs):
                    yield from own.rows(number)
                    own, number = Segment(), number + 1
                own.add(part.column(0).to_pylist(), texts)
        yield from own.rows(number)

    return docs.select("doc_id", "text").mapInArrow(run, _POSTINGS)


def impact(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A posting's share of a score, without its term's weight; 64-bit integers, divisions round down."""
    m = 10 + 90 * lengths * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class TermList:
    """One term's blocks in a segment; opened ones are kept."""

    def __init__(self, row: dict, lengths: np.ndarray, n_docs: int, n_terms: int):
        self.lasts, self.ends = np.frombuffer(row["lasts"], "<i4"), np.frombuffer(row["ends"], "<i4")
        tops = np.frombuffer(row["tops"], "<i8").reshape(-1, 3)
        at = np.searchsorted(tops[:, 0], np.arange(len(self.lasts)))
        self.most = np.maximum.reduceat(impact(tops[:, 1], tops[:, 2], n_docs, n_terms), at)
        self.weight, self.data = row["weight"], np.frombuffer(row["payload"], np.uint8)
        self.lengths, self.totals, self.opened = lengths, (n_docs, n_terms), {}

    def open(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, impacts) of a block, decompressed at its first use."""
        if block not in self.opened:
            low = self.ends[block - 1] if block else 0
            values = unpack(self.data[low : self.ends[block]]).reshape(-1, 2)
            places = np.cumsum(values[:, 0]) + (int(self.lasts[block - 1]) if block else -1)
            self.opened[block] = places, impact(values[:, 1], self.lengths[places], *self.totals)
        return self.opened[block]


def block_max_wand(lists: list[TermList], ids: np.ndarray, there: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of a segment's best documents for the lists of a query, equal scores by ids and null ids last."""
    edges = np.unique(np.concatenate([t.lasts for t in lists]))
    bounds, at = np.zeros(len(edges), np.int64), []
    for t in lists:  # shallow moves: the block that each list stands in up to each edge
        block = np.searchsorted(t.lasts, edges)
        inside = block < len(t.lasts)
        bounds[inside] += t.weight * t.most[block[inside]]
        at.append(block)
    order = np.argsort(-bounds, kind="stable")
    places, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    sums, done, take = np.zeros(int(edges[-1]) + 1, np.int64), 0, FIRST_STRETCHES
    while done < len(order):
        least = scores[top - 1] if len(scores) == top else 1
        chosen = order[done : done + take]
        chosen = chosen[bounds[chosen] >= least]  # an equal score may win by its id
        if not len(chosen):
            break
        asked, touched = np.zeros(len(edges), bool), []
        asked[chosen] = True
        for t, block in zip(lists, at, strict=True):
            for k in np.unique(block[chosen]).tolist():
                if k < len(t.lasts):
                    docs, impacts = t.open(k)
                    mine = asked[np.searchsorted(edges, docs)]
                    sums[docs[mine]] += t.weight * impacts[mine]
                    touched.append(docs[mine])
        found = np.unique(np.concatenate(touched))
        found = found[sums[found] > 0]
        places, scores = np.concatenate((places, found)), np.concatenate((scores, sums[found]))
        best = np.lexsort((ids[places], there[places] == 0, -scores))[:top]
        places, scores = places[best], scores[best]
        done, take = done + take, take * 2
    return places, scores


_FOUND = "item_id long, doc_id long, score long"


def _search(top: int, n_docs: int, n_terms: int):
    """Rows sorted by segment, the documents' first, to the best documents of each query; holds the asked terms of one segment."""

    def answer(docs: dict, rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
        lengths, ids, there = np.frombuffer(docs["lasts"], "<i8"), np.frombuffer(docs["payload"], "<i8"), np.frombuffer(docs["ends"], np.uint8)
        by: dict = {}
        for row in rows:
            own = TermList(row, lengths, n_docs, n_terms)
            for item in row["items"]:
                by.setdefault(item, []).append(own)
        out = []
        for item, lists in by.items():
            places, scores = block_max_wand(lists, ids, there, top)
            out += [(item, int(ids[p]) if there[p] else None, s) for p, s in zip(places.tolist(), scores.tolist(), strict=True)]
        return record_batch(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, docs, rows = arrow_schema(_FOUND), None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if row["term"] is None:
                        if rows:
                            yield answer(docs, rows, schema)
                        docs, rows = row, []
                    else:
                        rows.append(row)
        if rows:
            yield answer(docs, rows, schema)

    return run


class SearchIndex:
    """Segments in a folder; ``add`` writes more of them, ``search`` ranks the documents of all."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: int = 0, **sizes: int) -> None:
        """Indexes every row under a batch number of its own; done again, it replaces what it wrote. sizes: those that ``postings`` takes."""
        postings(id_and_text(docs, id_col, text_col), batch, **sizes).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/batch={batch}")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_POSTINGS).parquet(self.path).drop("batch")

    def search(self, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", top: int = TOP, query_pairs: int = QUERY_PAIRS) -> DataFrame:
        """(item_id, rank, doc_id, score) of each query's best documents."""
        spark, scratch, rows = self.spark, Scratch(self.spark), self.rows()
        n_docs, n_terms = rows.filter("term is null").agg(F.sum("n"), F.sum("total")).first()
        asked = staged(query_terms(queries, id_col, text_col), "asked", scratch)
        pairs = asked.count()
        if not n_docs or not pairs:
            scratch.clear()
            return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
        blocks = -(-pairs // query_pairs)
        names = asked.select("term").distinct()
        few = names.limit(20 * QUERY_PAIRS + 1).count() <= 20 * QUERY_PAIRS
        known = rows.filter("term is not null").select("term", "n").join(F.broadcast(names) if few else names, "term", "left_semi")
        asked = staged(with_weights(asked, known.groupBy("term").agg(F.sum("n").alias("df")), n_docs), "weighted", scratch)
        parts, found = int(spark.conf.get("spark.sql.shuffle.partitions")), None
        for k in range(blocks):
            # so many pairs at most, about: a query's terms stay together
            own = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).groupBy("term", "weight").agg(F.collect_list(F.struct("item_id")).alias("items"))
            own = own.select("term", "weight", F.col("items.item_id").alias("items"))
            lists = rows.filter("term is not null").join(F.broadcast(own), "term").select("segment", "term", "lasts", "ends", "tops", "payload", "weight", "items")
            heads = rows.filter("term is null").select("segment", "term", "lasts", "ends", "tops", "payload", F.lit(None).cast("long").alias("weight"), F.lit(None).cast("array<long>").alias("items"))
            placed = heads.unionByName(lists).repartition(parts, "segment").sortWithinPartitions("segment", F.col("term").asc_nulls_first())
            best = staged(placed.mapInArrow(_search(top, n_docs, n_terms), _FOUND), "found")
            found = best if found is None else found.unionByName(best)
        scratch.clear()
        order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

    def drop(self) -> None:
        delete(self.spark, self.path)


def query_terms(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term): the different terms of each query."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            return {"item_id": batch.column(0), "terms": [list(dict.fromkeys(w.decode() for w in terms_of(t.encode()))) for t in batch.column(1).to_pylist()]}

        return run

    rows = id_and_text(queries, id_col, text_col).withColumnRenamed("doc_id", "item_id")
    return map_rows(rows, make, "item_id long, terms array<string>", 512, text=1).select("item_id", F.explode("terms").alias("term")).distinct()


def with_weights(asked: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, term, weight) of the terms that some document holds: floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    return asked.join(counts, "term").select("item_id", "term", weight.cast("long").alias("weight"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = SearchIndex(spark, f"{shared_dir(spark)}/search-{uuid.uuid4().hex}")
    try:
        index.add(documents(spark, sf_dir))
        return index.search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    finally:
        index.drop()


QUERIES = {"op11_search": op11_search}
ORACLE_SQL = {
    "op11_search": r"""
        WITH lowered AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
             docs AS (SELECT r, doc_id, terms, len(terms) AS n FROM lowered WHERE len(terms) > 0),
             total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM docs),
             asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
             p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
             w AS (SELECT term, floor(1000 * ln((2.0 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), total),
             i AS (SELECT p.r, p.term, w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * d.n::BIGINT * nn) // ll))) AS s FROM p JOIN docs d USING (r) JOIN w USING (term), total),
             scored AS (SELECT item_id, r, sum(s)::BIGINT AS score FROM asked JOIN i USING (term) GROUP BY item_id, r HAVING sum(s) > 0)
        SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored JOIN docs USING (r))
        WHERE rank <= 10"""
}

"""Operator 3, near-duplicates: banded MinHash, odd sketches, exact confirmation.

A document's set holds its different shingles of five words. MinHash samples
are cut into bands; documents that agree in a band meet in a bucket. The same
samples are folded into an odd sketch, a bitmap of parities: the number of
bits in which two sketches differ estimates how many samples differ, and so
dismisses pairs whose similarity is clearly too low. What is left is confirmed
on the full sets of shingles, as strings.

Documents with the same words in the same order are one vertex, named by
SHA-256; where a name has several rows, their words are compared in full. No
group is expanded into pairs. Every vertex joins the cluster of the most
popular vertex that it meets in a bucket and is first compared with that one
only; the lead's text goes to as many tasks as the cluster fills. Members that
this doesn't link are compared, in blocks of bounded size, with all others of
their cluster that they aren't connected with yet. Then the buckets that still
join different components across clusters are searched, in blocks again, for
the pairs not yet compared; of these only those whose sketches agree leave the
join. Components follow from all confirmed links.

With 40 bands of 5 a pair at 0.85 is missed with probability 7e-11, at 0.8
with 1e-7.

Defined results: a document without words (null text included) has no shingle
and is linked with nothing; with fewer than five words its whole sequence is
the one shingle; rows that share a doc_id count as one document, which is
linked with whatever any of its texts is linked with; a null doc_id is linked
with nothing, its component is null and it is kept; very long texts are
compared whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Scratch, arrow_schema, confirm_names, documents, fresh, id_and_text, join_hot, record_batch, slices, staged
from tidemill.llm.components import components
from tidemill.llm.hashing import WordHasher, _numbers, mix

SHINGLE = 5
BANDS, ROWS = 40, 5
SKETCH_BITS = 512
#: Least similarity in percent that links two documents.
PERCENT = 85
#: Shingles that a block of a cluster holds, about.
BLOCK_SHINGLES = 100_000
#: Vertices of a bucket that are joined with each other in one place, at most about.
BUCKET_ROWS = 512
#: Ids up to this number are sent to all tasks (8 bytes each), names a quarter of it; more are joined by a shuffle.
SEND_IDS = 1_000_000

_hasher = WordHasher(3, lower=True)
_multipliers = _numbers(33, BANDS * ROWS) | np.uint64(1)
_salts = _numbers(34, BANDS * ROWS)
_lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: bytes) -> np.ndarray:
    """The different shingles of a text, as sorted 64-bit hashes."""
    return _distinct_runs(_hasher.words(text))


def _distinct_runs(words: np.ndarray) -> np.ndarray:
    return np.unique(_hasher.runs(words, min(SHINGLE, len(words)))) if len(words) else words


def normal_words(text: bytes) -> list[bytes]:
    """The words of a text, A to Z lower-cased; bytes split at the six ASCII white-space characters."""
    return text.translate(_lower).split()


def name_of(text: bytes) -> bytes | None:
    """SHA-256 of a text's words; None without words."""
    words = normal_words(text)
    return hashlib.sha256(b" ".join(words)).digest() if words else None


def shingle_set(text: bytes) -> set[tuple[bytes, ...]]:
    """The different shingles of a text, as they are."""
    words = normal_words(text)
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


def similar(one: set, other: set, percent: int) -> bool:
    common = len(one & other)
    return 100 * common >= percent * (len(one) + len(other) - common)


def minhash(hashes: np.ndarray) -> np.ndarray:
    best = np.full(len(_multipliers), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 2048):
        best = np.minimum(best, np.multiply.outer(_multipliers, hashes[start : start + 2048]).min(axis=1))
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((mix(samples + _salts) * _multipliers[::-1]).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)).view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of the samples' places, as 64-bit words."""
    with np.errstate(over="ignore"):
        places = (mix(samples ^ _salts) >> np.uint64(64 - int(math.log2(SKETCH_BITS)))).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=SKETCH_BITS).astype(np.uint8) & 1).view(np.int64)


def most_differing(percent: int) -> int:
    """Bits in which the sketches of a pair at the threshold differ at most, up to five deviations of the samples and three of the bits."""
    t, k = percent / 100, BANDS * ROWS
    samples = k * (1 - t) + 5 * math.sqrt(k * t * (1 - t))
    bits = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * samples))
    return math.ceil(bits + 3 * math.sqrt(bits * (1 - bits / SKETCH_BITS)))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, name, bands, sketch); only the first of equal texts in a task carries bands and sketch."""
    ddl = "doc_id long, n_shingles long, name binary, bands array<long>, sketch array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen = arrow_schema(ddl), set()
        for batch in batches:
            for part in slices(batch, 1):
                texts, out = [t.encode() for t in part.column(1).to_pylist()], []
                words, begins = _hasher.words_of(texts)
                for k, doc_id in enumerate(part.column(0).to_pylist()):
                    hashes = _distinct_runs(words[begins[k] : begins[k + 1]])
                    name = name_of(texts[k]) if len(hashes) and doc_id is not None else None
                    if name is None or name in seen:
                        out.append((doc_id, len(hashes), name, None, None))
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(name)
                    samples = minhash(hashes)
                    out.append((doc_id, len(hashes), name, band_keys(samples), odd_sketch(samples)))
                yield record_batch(out, schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ddl)


def _named(rows: DataFrame, body: bool) -> DataFrame:
    """(v, name, text) of (v, text); with ``body`` the normal words instead of the text."""
    ddl = "v long, name binary, text binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(ddl)
        for batch in batches:
            for part in slices(batch, 1):
                texts = [t.encode() for t in part.column(1).to_pylist()]
                names = [name_of(t) for t in texts]
                yield record_batch(list(zip(part.column(0).to_pylist(), names, [b" ".join(normal_words(t)) for t in texts] if body else texts, strict=True)), schema)

    return rows.select("v", "text").mapInArrow(run, ddl)


def with_ids(frame: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """frame joined with distinct ids (v): they are sent to all tasks if few, else both sides are shuffled."""
    few = ids.limit(SEND_IDS + 1).count() <= SEND_IDS
    return frame.join(F.broadcast(ids) if few else ids, "v", how)


def confirm_copies(docs: DataFrame, signed: DataFrame, id_col: str, text_col: str) -> None:
    """Compares the words of all rows of one name in full."""
    several = signed.filter("name is not null").groupBy("name").count().filter("count > 1").select("name")
    few = several.limit(SEND_IDS // 4 + 1).count() <= SEND_IDS // 4
    rows = _named(id_and_text(docs, id_col, text_col).withColumnRenamed("doc_id", "v"), True)
    confirm_names(rows.join(F.broadcast(several) if few else several, "name", "left_semi").select("name", F.col("text").alias("body")))


class Forest:
    """Union-find over local places."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> None:
        self.up[self.root(a)] = self.root(b)


def _compare_leads(percent: int):
    """Rows (lead, salt, member, v, text, n, sketch) sorted so that leads come first to links of members with them; holds the lead's sets only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, key, leads, most = arrow_schema("a long, b long"), None, [], most_differing(percent)
        for batch in batches:
            for part in slices(batch, 4):
                out = []
                for lead, salt, member, v, text, n, sketch in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if (lead, salt) != key:
                        key, leads = (lead, salt), []
                    bits = np.array(sketch, np.int64).view(np.uint64)
                    if not member:
                        leads.append((bits, n, shingle_set(text)))
                        continue
                    own = None
                    for of_lead, size, known in leads:
                        if 100 * min(n, size) >= percent * max(n, size) and np.bitwise_count(bits ^ of_lead).sum() <= most:
                            own = own or shingle_set(text)
                            if similar(own, known, percent):
                                out.append((v, lead))
                                break
                yield record_batch(out, schema)

    return run


def compare_block(members: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Confirmed links of open members with others. members: (open, v, text, n, sketch, linked): linked ones are connected already."""
    sketches = np.array([m[4] for m in members], np.int64).view(np.uint64)
    sizes, most, sets, forest, links = np.array([m[3] for m in members]), most_differing(percent), {}, Forest(len(members)), []
    first = None
    for k, m in enumerate(members):
        if m[5]:
            first = k if first is None else first
            forest.join(k, first)

    def of(k: int) -> set:
        if k not in sets:
            sets[k] = shingle_set(members[k][2])
        return sets[k]

    for a in [k for k, m in enumerate(members) if m[0]]:
        differing = np.bitwise_count(sketches ^ sketches[a]).sum(axis=1)
        near = np.flatnonzero((differing <= most) & (100 * np.minimum(sizes, sizes[a]) >= percent * np.maximum(sizes, sizes[a])))
        for b in near[np.argsort(differing[near], kind="stable")].tolist():
            if forest.root(a) != forest.root(b) and similar(of(a), of(b), percent):
                forest.join(a, b)
                links.append((members[a][1], members[b][1]))
    return links


def _compare_blocks(percent: int):
    """Sorted rows (lead, i, j, open, v, text, n, sketch, linked) to links; holds one block pair at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, key, members, out = arrow_schema("a long, b long"), None, [], []
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for lead, i, j, *member in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if (lead, i, j) != key:
                        out += compare_block(members, percent)
                        key, members = (lead, i, j), []
                    members.append(tuple(member))
            if len(out) > 4096:
                yield record_batch(out, schema)
                out = []
        out += compare_block(members, percent)
        yield record_batch(out, schema)

    return run


def _confirm_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, last, known = arrow_schema("a long, b long"), None, set()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part, out = batch.slice(start, 512), []
                for a, b, text_a, text_b in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                    if text_a != last:
                        last, known = text_a, shingle_set(text_a)
                    if similar(known, shingle_set(text_b), percent):
                        out.append((a, b))
                yield record_batch(out, schema)

    return run


def _bits(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def confirmed_links(docs: DataFrame, vertices: DataFrame, percent: int, id_col: str, text_col: str, scratch: Scratch, block_shingles: int = BLOCK_SHINGLES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect all vertices (v, name, n, bands, sketch) of similarity percent or more."""
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    met = vertices.select("v", "name", F.explode("bands").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("size"), F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo < hi").select("key", "size")
    total = shared.agg(F.sum("size")).first()[0] or 0
    shared = staged(shared, "shared", scratch)
    buckets = staged(join_hot(met, shared, ["key"], "size", total), "buckets", scratch)  # the few buckets with more than one vertex

    popular = buckets.groupBy("v").agg(F.sum("size").alias("pop"))
    leads = buckets.join(popular, "v").groupBy("key").agg(F.max(F.struct("pop", (-F.col("v")).alias("neg"))).alias("top"), F.first("size").alias("size"))
    leads = staged(leads, "leads", scratch)
    lead_of = staged(join_hot(buckets.drop("size"), leads, ["key"], "size", total).groupBy("v").agg(F.max("top").alias("top")).select("v", (-F.col("top.neg")).alias("lead")), "lead-of", scratch)
    texts = staged(_named(with_ids(id_and_text(docs, id_col, text_col).withColumnRenamed("doc_id", "v"), lead_of.select("v")), False), "texts", scratch)
    marks = vertices.select("v", "name", "n", "sketch")
    members = lead_of.filter("v <> lead").join(marks, "v")
    sizes = members.groupBy("lead").agg(F.sum("n").alias("shingles"), F.count("*").alias("m"))
    sizes = staged(sizes.select("lead", "m", F.ceil(F.col("shingles") / block_shingles).cast("int").alias("salts")), "sizes", scratch)
    clustered = sizes.agg(F.sum("m")).first()[0] or 0

    # each member with its lead
    columns = ["lead", "salt", "member", "v", "text", "n", "sketch"]
    placed = join_hot(members, sizes, ["lead"], "m", clustered).withColumn("salt", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int")).withColumn("member", F.lit(True))
    stars = sizes.select("lead", F.col("lead").alias("v"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("member")).join(marks, "v")
    dealt = placed.select("lead", "salt", "member", "v", "name", "n", "sketch").unionByName(stars).join(texts, ["v", "name"]).select(*columns)
    dealt = dealt.repartition(tasks, "lead", "salt").sortWithinPartitions("lead", "salt", "member")
    star = staged(dealt.mapInArrow(_compare_leads(percent), "a long, b long"), "star", scratch)

    # those that aren't linked with it, and all others of their clusters
    tied = star.select(F.col("a").alias("v")).distinct().withColumn("linked", F.lit(True))
    state = lead_of.filter("v <> lead").unionByName(sizes.select(F.col("lead").alias("v"), "lead")).join(tied, "v", "left")
    state = state.join(marks, "v").withColumn("linked", F.col("linked").isNotNull() | (F.col("v") == F.col("lead")))
    block = lambda c: F.ceil(F.sum(c) / block_shingles).cast("int")
    loose = state.groupBy("lead").agg(block(F.when(~F.col("linked"), F.col("n"))).alias("is"), block("n").alias("js"), F.count_if(~F.col("linked")).alias("open"), F.count("*").alias("m")).filter("open > 0 and m > 2")
    loose = staged(loose, "loose", scratch)
    inside = star
    own = lambda c: F.pmod(F.xxhash64("v"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    if not loose.isEmpty():
        cluster = staged(join_hot(state, loose, ["lead"], "m", clustered), "cluster", scratch)
        first = cluster.filter(~F.col("linked")).withColumn("i", own("is")).withColumn("j", every("js")).withColumn("open", F.lit(True))
        second = cluster.withColumn("j", own("js")).withColumn("i", every("is")).withColumn("open", F.lit(False))
        columns = ["lead", "i", "j", "open", "v", "text", "n", "sketch", "linked"]
        pairs = first.unionByName(second).join(texts, ["v", "name"]).select(*columns).repartition(tasks, "lead", "i", "j").sortWithinPartitions("lead", "i", "j")
        blocks = staged(pairs.mapInArrow(_compare_blocks(percent), "a long, b long"), "blocks", scratch)
        inside = star.unionByName(blocks)

    # buckets that still hold different components of different clusters
    found = components(inside, scratch)
    state = lead_of.join(found, "v", "left").select("v", "lead", F.coalesce("component", "v").alias("comp"))
    open_ones = staged(buckets.join(state, "v"), "states", scratch)
    mixed = open_ones.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("lead").alias("l0"), F.max("lead").alias("l1"), F.count("*").alias("m")).filter("c0 < c1 and l0 < l1")
    mixed = staged(mixed.select("key", "m", F.ceil(F.col("m") / bucket_rows).cast("int").alias("parts")), "mixed", scratch)
    if mixed.isEmpty():
        return inside
    left = join_hot(open_ones.drop("size"), mixed, ["key"], "m", mixed.agg(F.sum("m")).first()[0] or 0).join(marks, ["v", "name"])
    left = staged(left.select("key", "v", "name", "lead", "comp", "n", "sketch", "parts"), "open", scratch)
    a = left.withColumn("i", own("parts")).withColumn("j", every("parts")).alias("a")
    b = left.withColumn("j", own("parts")).withColumn("i", every("parts")).alias("b")
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    apart = (F.col("a.comp") != F.col("b.comp")) & (F.col("a.lead") != F.col("b.lead")) & (F.col("a.lead") != F.col("b.v")) & (F.col("b.lead") != F.col("a.v"))
    alike = (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) & (_bits(F.col("a.sketch"), F.col("b.sketch")) <= most_differing(percent))
    pairs = a.join(b, same & (F.col("a.v") < F.col("b.v")) & apart & alike).select(F.col("a.v").alias("a"), F.col("a.name").alias("na"), F.col("b.v").alias("b"), F.col("b.name").alias("nb")).distinct()
    pairs = staged(pairs, "pairs", scratch)
    needed = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v"))).distinct()
    some = with_ids(texts, needed)
    both = pairs.join(some.toDF("a", "na", "ta"), ["a", "na"]).join(some.toDF("b", "nb", "tb"), ["b", "nb"])
    return inside.unionByName(both.select("a", "b", "ta", "tb").mapInArrow(_confirm_pairs(percent), "a long, b long"))


def near_groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): a row for each document. sizes: those that ``confirmed_links`` takes."""
    scratch = Scratch(docs.sparkSession)
    signed = staged(signatures(docs, id_col, text_col), "signatures", scratch)
    confirm_copies(docs, signed, id_col, text_col)
    carriers = signed.filter(F.col("bands").isNotNull()).groupBy("name").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("x"))
    vertices = staged(carriers.select("name", F.col("x.doc_id").alias("v"), F.col("x.n_shingles").alias("n"), F.col("x.bands").alias("bands"), F.col("x.sketch").alias("sketch")), "vertices", scratch)
    links = confirmed_links(docs, vertices, percent, id_col, text_col, scratch, **sizes)
    # the texts of one id are linked by it
    texts = signed.filter("name is not null").select("doc_id", "name")
    several = texts.groupBy("doc_id").agg(F.min("name").alias("x"), F.max("name").alias("y")).filter("x <> y").select("doc_id")
    first = texts.groupBy("name").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    names = staged(vertices.select("name", "v").join(first, "name"), "names", scratch)
    links = links.unionByName(texts.join(several, "doc_id").distinct().join(names, "name").select(F.col("doc_id").alias("a"), F.col("v").alias("b")))
    links = links.unionByName(names.filter("v <> first").select(F.col("v").alias("a"), F.col("first").alias("b")))
    found = components(links, scratch)
    of_name = names.join(found, "v", "left").filter("copies > 1 or component is not null").select("name", "copies", F.coalesce("component", "first").alias("component_id"))
    of_name = staged(of_name, "components", scratch)
    named = signed.filter("name is not null").select("doc_id", "n_shingles", "name")
    grouped = join_hot(named, of_name, ["name"], "copies", of_name.agg(F.sum("copies")).first()[0] or 0).select("doc_id", "n_shingles", "component_id")
    alone = named.join(of_name.select("name"), "name", "left_anti").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    # a row without words follows the other rows of its id
    empty = signed.filter("name is null").select("doc_id", "n_shingles")
    ids = empty.filter("doc_id is not null").select("doc_id").distinct()
    of_id = texts.join(ids, "doc_id").join(of_name, "name").groupBy("doc_id").agg(F.min("component_id").alias("c"))
    empty = empty.join(of_id, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"))
    out = staged(grouped.unionByName(alone).unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near")
    scratch.clear()
    return out


def drop_near_copies(docs: DataFrame, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one document of each group, with all their columns."""
    gone = staged(near_groups(docs, percent, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("v")).distinct(), "gone")
    names, key, (own,) = [F.col(f"`{n}`") for n in docs.columns], F.col(f"`{id_col}`").cast("long"), fresh(docs, "near_gone")
    few = gone.limit(SEND_IDS + 1).count() <= SEND_IDS
    return docs.join((F.broadcast(gone) if few else gone).withColumnRenamed("v", own), key == F.col(own), "left_anti").select(*names)


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))


QUERIES = {"op3_neardup": op3_neardup}
ORACLE_SQL = {
    "op3_neardup": r"""
        WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words FROM documents),
             s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
                   FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS i FROM d WHERE len(words) > 0)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
             c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
             e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
             r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
        SELECT a AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(b) AS component_id, a = min(b) AS kept FROM r LEFT JOIN n ON n.doc_id = a GROUP BY a""",
}

"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from tidemill.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(docs, items, top=10):
    counted = [(i, Counter(ts), len(ts)) for i, ts in ((i, _terms(t)) for i, t in docs) if ts]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, {}).update(dict.fromkeys(_terms(text)))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c, length in counted:
            m = 10 + 90 * length * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def _got(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=repr)


def test_search_query(spark, sf_dir, documents_here):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert _got(search.op11_search(spark, sf_dir)) == _brute(documents_here, items)


def _corpus(r, n):
    """Frequent and rare words, ties, repeated rows, nulls."""
    words = [f"w{k}" for k in range(60)]
    rows = [(r.randrange(n), " ".join(r.choices(words, [1 / (k + 1) for k in range(60)], k=r.randrange(1, 40)))) for _ in range(n)]
    return rows + [(None, "W1 w2"), (None, None), (5, ""), (7, "w3 w3"), (7, "w3 w3"), (8, "Été w59!été"), (9, "W59" * 3), (10, "w1 " * 3000)]


def test_search_in_segments_and_query_blocks(spark, tmp_path):
    """Many small segments in two batches, queries in several blocks, one id with two texts, unknown terms, and a batch that is added again."""
    r = random.Random(4)
    rows = _corpus(r, 700)
    items = [(k, " ".join(f"W{r.randrange(64)}" for _ in range(r.randrange(1, 9)))) for k in range(25)] + [(3, "w3 été"), (None, "w59"), (90, "none"), (91, None), (92, "w1 w1 w1")]
    index = search.SearchIndex(spark, str(tmp_path / "index"))
    make = lambda part: spark.createDataFrame(part, "doc_id long, text string").repartition(3)
    index.add(make(rows[:400]), segment_docs=150)
    index.add(make(rows[:100]), batch=1)
    index.add(make(rows[400:]), batch=1, segment_bytes=2000)
    queries = spark.createDataFrame(items, "item_id long, text string")
    wanted = _brute(rows, items)
    assert _got(index.search(queries)) == wanted == _got(index.search(queries, query_pairs=20))
    assert _got(index.search(queries, top=3)) == _brute(rows, items, 3)
    index.drop()


def _lists(spark, rows, terms, **sizes):
    """The lists of some terms of a segment, and its ids."""
    made = search.postings(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), **sizes).collect()
    head = next(x for x in made if x.term is None)
    lengths = np.frombuffer(head.lasts, "<i8")
    return [search.TermList(x.asDict() | {"weight": 5}, lengths, head.n, head.total) for x in made if x.term in terms], np.frombuffer(head.payload, "<i8"), np.frombuffer(head.ends, np.uint8)


def test_blocks_below_the_threshold_stay_closed(spark):
    """A rare strong stretch comes first; the blocks elsewhere are never decompressed."""
    rows = [(k, "a " * (30 if 1000 <= k < 1015 else 1) + "filler " * 20) for k in range(5000)]
    lists, ids, there = _lists(spark, rows, {"a"})
    places, scores = search.block_max_wand(lists, ids, there, 10)
    assert places.tolist() == list(range(1000, 1010)) and len(set(scores.tolist())) == 1
    assert len(lists[0].opened) < len(lists[0].lasts) / 2


def test_block_maxima_are_reached(spark):
    """A block's maximum is the greatest impact of its postings, whatever the statistics are."""
    r = random.Random(6)
    rows = [(k, " ".join(["a"] * r.randrange(0, 9) + ["b"] * r.randrange(1, 50))) for k in range(900)]
    lists, _, _ = _lists(spark, rows, {"a", "b"})
    for t in lists:
        for k in range(len(t.lasts)):
            places, impacts = t.open(k)
            assert impacts.max() == t.most[k] and places[-1] == t.lasts[k] and len(places) <= search.BLOCK


def test_packed_numbers_come_back():
    r = np.random.default_rng(2)
    for values in (np.array([0, 1, 127, 128, 16383, 16384, 2**40, 2**62]), r.integers(0, 400, 1000), np.empty(0, np.int64)):
        data, ends = search.pack(values)
        assert search.unpack(data).tolist() == values.tolist() and len(ends) == len(values)


def test_search_of_nothing(spark, nothing, odd, tmp_path):
    for k, (docs, queries) in enumerate(((nothing, odd), (odd, nothing), (odd.filter("text is null"), odd))):
        index = search.SearchIndex(spark, str(tmp_path / str(k)))
        index.add(docs)
        assert index.search(queries, id_col="doc_id").count() == 0


def test_search_on_odd_rows(odd, odd_rows, spark, tmp_path):
    index = search.SearchIndex(spark, str(tmp_path))
    index.add(odd)
    assert _got(index.search(odd.filter("size(split(text, ' ')) < 500"), "doc_id")) == _brute(odd_rows, [(i, t) for i, t in odd_rows if t is not None and len(t.split(" ")) < 500])


def test_search_sql(spark, sf_dir):
    """The SQL gives the same rows."""
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    got = con.sql(search.ORACLE_SQL["op11_search"]).fetchall()
    assert sorted(map(tuple, got), key=repr) == _got(search.op11_search(spark, sf_dir))

"""Alignment of two tokenizers against whole texts through the libraries themselves."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemill.llm import align
from tidemill.llm.bpe import tokenizer_path


@pytest.fixture(scope="module")
def both():
    return align.TwoTokenizers(tokenizer_path(align.BYTE_BPE), tokenizer_path(align.PIECE_BPE))


def _plain(both, text):
    """(ids of A, ids of B, groups, links) of a whole text; None without tokens."""
    if not text:
        return None
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(both.a_bytes[k] for k in a) != whole or b"".join(both.b_bytes[k] for k in b) != whole:
        return None
    ends_a, ends_b = np.cumsum([len(both.a_bytes[k]) for k in a]).tolist(), np.cumsum([len(both.b_bytes[k]) for k in b]).tolist()
    at_a, at_b = {e: k for k, e in enumerate(ends_a)}, {e: k for k, e in enumerate(ends_b)}
    links, groups, i, j = [], [], 0, 0
    for cut in sorted(at_a.keys() & at_b.keys()):
        p, q = at_a[cut] + 1, at_b[cut] + 1
        links.append((a[p - 1], b[q - 1]))
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return a, b, groups, links


def _brute(both, rows):
    found = [(i, _plain(both, t)) for i, t in rows]
    counts = Counter(link for _, f in found if f for link in f[3])
    best: dict = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def test_align_query(spark, sf_dir, both, documents_here):
    assert _got(align.op12_align(spark, sf_dir)) == _brute(both, documents_here)


def test_align_on_odd_rows(odd, both, odd_rows):
    assert _got(align.pair_statistics(odd)) == _brute(both, odd_rows)


def test_parts_equal_whole_texts(both):
    """Texts cut at spaces give what the libraries give for whole texts, special tokens and odd spaces included."""
    r = random.Random(5)
    bits = [" ", "  ", "   ", "\n", " \n", "\n ", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "a", "The", "ing", "'s", "'ll", "123", "4", "!?", "...", "é", "é", "日本", "\U0001f600", "\x00", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x41>", "﻿", "​", "᠎", "▁", "́", "ال", "_", "x" * 50]
    seen = 0
    for n in range(6000):
        text = "".join(r.choice(bits if n % 3 else bits[:-5]) for _ in range(r.randrange(1, 12)))
        plain, (a, b, groups, pairs) = _plain(both, text), both.text(text)
        if plain is None:
            assert (a, b, groups, pairs) == (0, 0, "", b""), repr(text)
            continue
        seen += 1
        assert (a, b) == (len(plain[0]), len(plain[1])), repr(text)
        assert groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain[2]), repr(text)
        assert [(k & 0xFFFFFFFF, k >> 32) for k in np.frombuffer(pairs, "<i8").tolist()] == plain[3], repr(text)
    assert seen > 3000


def test_shards_sum_runs_and_find_keys(spark, tmp_path):
    """Runs that lie in several batches of a range are one key; keys beside those of the shards have no count."""
    r = random.Random(8)
    rows = [(r.randrange(40) << 32 | r.randrange(6), r.randrange(1, 5)) for _ in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        made = align.count_shards(spark.createDataFrame(rows, "pair long, n long").repartition(5), f"file://{tmp_path}", 3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = Counter()
    for k, n in rows:
        wanted[k] += n
    known = align.CountShards(f"file://{tmp_path}", [(s.stem, s.lo, s.n) for s in made])
    keys = np.array(sorted(wanted) + [-1, 0, 7, 41 << 32, 5 << 32 | 9], np.int64)
    assert known.counts(keys).tolist() == [wanted.get(k, 0) for k in keys.tolist()]
    tops: dict = {}
    for s in made:
        for k, n in zip(np.frombuffer(s.ids, "<i8").tolist(), np.frombuffer(s.tops, "<i8").tolist(), strict=True):
            tops[k] = max(tops.get(k, 0), n)
    assert tops == {b: max(n for k, n in wanted.items() if k >> 32 == b) for b in {k >> 32 for k in wanted}}
    assert known.counts(np.empty(0, np.int64)).tolist() == []


def test_partial_counts_in_small_batches(spark):
    """Batches that are sent on early only repeat keys; their sums stay."""
    r = random.Random(9)
    rows = [([r.randrange(30) for _ in range(r.randrange(20))]) for _ in range(60)]
    frame = spark.createDataFrame([(np.array(x, "<i8").tobytes(),) for x in rows] + [(None,)], "links binary").coalesce(1)
    found = align.partial_counts(frame, 16, 20).collect()
    sums = Counter()
    for x in found:
        sums[x.pair] += x.n
    assert sums == Counter(k for x in rows for k in x) and len(found) > len(sums)


def test_align_of_nothing(spark, nothing):
    assert align.pair_statistics(nothing).count() == 0
    none = align.pair_statistics(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert [tuple(r[c] for c in COLUMNS[1:]) for r in none] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_groups_as_output(spark):
    found = align.aligned(spark.createDataFrame([(1, "the cats")], "doc_id long, text string")).first()
    assert found.n_links == found.groups.count(";") + 1 and hashlib.sha256(found.groups.encode()).hexdigest() == found.groups_sha256

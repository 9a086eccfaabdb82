"""Removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemill.llm import suffix
from tidemill.llm.common import Scratch

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _brute(rows, window=200):
    texts, seen, out = [(t or "").encode() for _, t in rows], {}, []
    for t in texts:
        for k in range(len(t) - window + 1):
            w = t[k : k + window]
            seen[w] = seen.get(w, 0) + 1
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - window + 1):
            if seen[t[k : k + window]] > 1:
                gone[k : k + window] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((i, len(t), len(t) - len(kept), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _got(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=repr)


def _made(r, n):
    """Texts with shared passages that begin and end anywhere, mutations, runs of one byte and periods."""
    passages = ["".join(r.choice("abcdé \n") for _ in range(r.choice([150, 199, 200, 201, 260, 500, 900]))) for _ in range(6)]
    out = []
    for k in range(n):
        text = "".join(r.choice("abcdefgh ") for _ in range(r.randrange(300)))
        for _ in range(r.randrange(4)):
            p = r.choice(passages)
            a = r.randrange(0, 60)
            text += p[a : len(p) - r.randrange(60)] + "".join(r.choice("xyz\x00") for _ in range(r.randrange(3)))
        if k % 9 == 0:
            text += r.choice(["q" * 450, "pq" * 170, "\x00" * 230, "abc" * 100])
        out.append((k, text))
    return out


def test_suffix_on_made_up_texts(spark):
    rows = _made(random.Random(1), 60)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = _brute(rows)
    assert _got(suffix.without_repeated_bytes(frame)) == wanted
    assert any(r[2] for r in wanted) and any(r[3] > 1 for r in wanted)


@pytest.mark.parametrize(("part_kinds", "hot_kinds"), [(1, 8192), (1, 1), (1, 3)])
def test_anchors_with_many_spans(spark, part_kinds, hot_kinds):
    """Divided by offset, and window by window over buckets that equal suffixes cross."""
    rows = _made(random.Random(2), 30)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _got(suffix.without_repeated_bytes(frame, part_kinds=part_kinds, hot_kinds=hot_kinds)) == _brute(rows)


def test_suffix_on_odd_rows(odd, odd_rows):
    assert _got(suffix.without_repeated_bytes(odd)) == _brute(odd_rows)


def test_suffix_query(spark, sf_dir, documents_here):
    found = sorted((tuple(r[c] for c in COLUMNS) for r in suffix.op13_suffix(spark, sf_dir).collect()), key=repr)
    assert found == _brute(documents_here)
    assert any(r[2] for r in found)


def test_suffix_of_nothing(spark, nothing):
    assert suffix.without_repeated_bytes(nothing).count() == 0


def test_equal_suffixes_cross_buckets(spark):
    """One suffix fills several buckets, others are alone; neighbours beyond a boundary count."""
    rows = [(b"m" * 5, k, 0, 0, 0, 1) for k in range(50)] + [(bytes([97 + k]) * 5, 100 + k, 0, 0, 0, 1) for k in range(26) if chr(97 + k) != "m"] + [(b"zz", 200, 0, 0, 0, 2)]
    frame = spark.createDataFrame(rows, "suffix binary, h long, s long, c int, w int, n long").repartition(4)
    scratch = Scratch(spark)
    for ranges in (1, 7, 60):
        assert sorted(r.h for r in suffix.sorted_windows(frame, ranges, scratch).collect()) == [*range(50), 200]
    scratch.clear()


def test_multikey_order():
    r = np.random.default_rng(4)
    for n, m in ((0, 3), (1, 2), (300, 4), (500, 1)):
        groups, tokens = r.integers(0, 4, n), r.integers(0, 3, (n, m)).astype(np.uint64)
        order = suffix.multikey_order(groups, tokens)
        assert sorted(order.tolist()) == list(range(n))
        listed = [(groups[k], *tokens[k]) for k in order.tolist()]
        assert listed == sorted(listed)


def test_spans_over_segments(monkeypatch):
    """Windows of a text of several segments have the anchors that they have alone."""
    r = random.Random(3)
    text = "".join(r.choice("abcd") for _ in range(3000)).encode()
    whole = np.concatenate([np.repeat(s + b, z) for s, z, b, _ in suffix.text_spans(text)])
    monkeypatch.setattr(suffix, "SEGMENT", 512)
    parts = np.concatenate([np.repeat(s + b, z) for s, z, b, _ in suffix.text_spans(text)])
    assert (whole == parts).all() and len(whole) == 2801
    for k in (0, 500, 511, 512, 2800):
        assert whole[k] - k == next(iter(suffix.text_spans(text[k : k + 200])))[2][0]

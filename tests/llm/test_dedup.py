"""Exact, near and substring deduplication against brute force."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemill.llm import exact, neardup, substring


def test_exact_on_odd_rows(odd, odd_rows):
    found = exact.equal_groups(odd).select("doc_id", "keep_id", "group_size", "kept", "sha").collect()
    assert sorted(((*r[:4], bytes(r[4]).hex()) for r in found), key=repr) == brute.exact(odd_rows)


def test_exact_drop_keeps_columns_and_one_row(odd, odd_rows):
    left = exact.drop_copies(odd)
    assert left.columns == odd.columns
    texts = [brute.normal(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({brute.normal(t) for _, t in odd_rows})


def test_exact_query(spark, sf_dir, documents_here):
    found = exact.op8_exact(spark, sf_dir).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in found), key=repr) == brute.exact(documents_here)


def test_exact_small_blocks(spark, odd, odd_rows, monkeypatch):
    """Copies that fall into different blocks meet in the sort."""
    monkeypatch.setattr(exact, "BLOCK_ROWS", 3)
    import pyarrow as pa

    rows = [(i, t or "") for i, t in odd_rows]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], names=["doc_id", "text"])
    merged = [r for b in exact._merge_blocks(iter([batch])) for r in b.to_pylist()]
    carriers = sorted((r for r in merged if r["copies"] is not None), key=lambda r: (r["lead"], r["sha"], r["body"]))
    heads = pa.RecordBatch.from_pylist([{k: r[k] for k in ("body", "sha", "carrier_id", "copies")} for r in carriers])
    groups = {(r["sha"], r["carrier_id"]): r for b in exact._compare_neighbours(iter([heads])) for r in b.to_pylist()}
    got = [(r["doc_id"], (g := groups[r["sha"], r["carrier_id"]])["keep_id"], g["group_size"], r["doc_id"] == g["keep_id"], r["sha"].hex()) for r in merged if r["copies"] is None]
    assert sorted(got, key=repr) == brute.exact(odd_rows)


def test_exact_hot_text(spark, odd, odd_rows, monkeypatch):
    """Texts with more carriers than allowed are merged in salted groups first."""
    rows = [(k, "hot text  here" if k % 3 else "hot text here") for k in range(40)] + [(None, "hot text here"), (None, "other")] + [(k, f"x{k}") for k in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    for docs, wanted in ((frame, rows), (odd, odd_rows)):
        found = exact.equal_groups(docs, hot_carriers=1).select("doc_id", "keep_id", "group_size", "kept", "sha").collect()
        assert sorted(((*r[:4], bytes(r[4]).hex()) for r in found), key=repr) == brute.exact(wanted)


def test_exact_keeps_one_of_equal_ids(spark):
    """The same id with texts that differ in white space only: the least text stays, and other columns keep their names."""
    rows = [(1, "a  b", {"x": 1}, "q"), (1, "a b", {"x": 2}, "r"), (1, "a\tb", {"x": 3}, "s"), (2, None, None, "t"), (2, "", None, "u")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, copy_row map<string,int>, copy_sha string").repartition(3)
    left = exact.drop_copies(frame)
    assert left.columns == frame.columns
    assert sorted((r.doc_id, r.text, r.copy_sha) for r in left.collect()) == [(1, "a\tb", "s"), (2, "", "u")]


def test_near_query(spark, sf_dir, documents_here):
    wanted = brute.near_groups(documents_here)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.op3_neardup(spark, sf_dir).collect()}
    assert found == wanted
    assert any(i != c for i, (_, c) in wanted.items())


def test_near_on_odd_rows(odd, odd_rows):
    found = neardup.near_groups(odd).collect()
    assert len(found) == len(odd_rows)
    wanted = brute.near_groups([(i, t) for i, t in odd_rows if i is not None])
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*wanted[r.doc_id], wanted[r.doc_id][1] == r.doc_id)


def test_near_blocks_lose_no_link(spark):
    """A star of near copies that is compared in many blocks, and chains of copies of copies."""
    r = random.Random(4)
    rows, base = [(0, brute.made_up(r, 80))], brute.made_up(r, 80)
    for k in range(1, 60):
        rows.append((k, brute.mutated(base, r, r.choice([0.002, 0.01, 0.02, 0.05]))))
    for k in range(60, 90):
        rows.append((k, brute.mutated(rows[-1][1], r, 0.012)))
    rows = [(i, " ".join(w)) for i, w in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = brute.near_groups(rows)
    found = neardup.near_groups(frame, block_shingles=400, bucket_rows=2).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in found} == wanted


def test_near_shared_ids(spark):
    """Rows that share an id are one document, linked with whatever any of its texts is linked with."""
    r = random.Random(7)
    a, b, c = (" ".join(brute.made_up(r, 40)) for _ in range(3))
    rows = [(5, a), (5, b), (3, a), (9, b), (9, ""), (7, c), (7, None), (4, ""), (8, c + " ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in neardup.near_groups(frame).collect())
    assert found == [(3, 36, 3, True), (4, 0, 4, True), (5, 36, 3, False), (5, 36, 3, False), (7, 0, 7, True), (7, 36, 7, True), (8, 36, 7, False), (9, 0, 3, False), (9, 36, 3, False)]
    assert sorted(x.doc_id for x in neardup.drop_near_copies(frame, 85).collect()) == [3, 4, 7, 7]


def test_near_by_small_parameters(spark, odd, odd_rows, monkeypatch):
    """Ids that are joined by a shuffle, and hubs, leads and copies that are sent to all tasks."""
    import functools

    from tidemill.llm import common, components

    monkeypatch.setattr(neardup, "SEND_IDS", 0)
    for module in (neardup, components):
        monkeypatch.setattr(module, "join_hot", functools.partial(common.join_hot, hot_part=0.0, hot_rows=3))
    wanted = brute.near_groups([(i, t) for i, t in odd_rows if i is not None])
    found = neardup.near_groups(odd, block_shingles=300, bucket_rows=3).collect()
    assert len(found) == len(odd_rows)
    assert all((x.n_shingles, x.component_id) == wanted[x.doc_id] for x in found if x.doc_id is not None)


def test_equal_sets_in_another_order(spark):
    """Equal sets of shingles of different texts are linked by comparing the sets."""
    words = [f"w{k}" for k in range(30)]
    rows = [(1, " ".join(words * 2)), (2, " ".join(words * 3)), (3, " ".join(reversed(words)))]
    found = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute.near_groups(rows) and found[2] == (30, 1)


def test_sketch_never_dismisses_a_link():
    r = random.Random(8)
    for _ in range(60):
        base = brute.made_up(r, 300)
        a, b = " ".join(base).encode(), " ".join(brute.mutated(base, r, 0.01)).encode()
        s, t = neardup.shingle_set(a), neardup.shingle_set(b)
        if 100 * len(s & t) >= 85 * len(s | t):
            x, y = (neardup.odd_sketch(neardup.minhash(neardup.shingle_hashes(d))) for d in (a, b))
            differing = sum(bin(int(p) & (2**64 - 1)).count("1") for p in x ^ y)
            assert differing <= neardup.most_differing(85)
        assert len(s) == len(neardup.shingle_hashes(a))


def test_substring_query(spark, sf_dir, documents_here):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.op6_substring(spark, sf_dir).collect()}
    wanted = dict(zip((i for i, _ in documents_here), brute.substring([t for _, t in documents_here]), strict=True))
    assert found == wanted
    assert any(n for _, n, _ in wanted.values())


def test_substring_on_odd_rows(odd, odd_rows):
    from pyspark.sql import functions as F

    found = substring.without_repeats(odd).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    wanted = [(i, *x) for (i, _), x in zip(odd_rows, brute.substring([t for _, t in odd_rows]), strict=True)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    left = substring.remove_repeats(odd)
    assert left.columns == odd.columns and left.count() == len(odd_rows)


def _thue_morse(a, b):
    word, other = a, b
    for _ in range(9):
        word, other = word + other, other + word
    return word


def test_words_that_a_shared_base_would_confuse(spark):
    """Thue-Morse words and their complements agree under any polynomial modulo a power of two."""
    x, y = _thue_morse("a", "b"), _thue_morse("b", "a")
    assert len(x) == 512 and x != y
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words[:20] + [x * 2] + words[20:])), (2, " ".join(words[:20] + [y * 2] + words[20:])), (3, "a b c " + x * 2 + " d e f"), (4, "a b c " + y * 2 + " d e f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_removed for r in substring.without_repeats(frame).collect()} == {0}
    assert all(r.kept for r in neardup.near_groups(frame).collect())


class _Weak(substring.WordHasher):
    """Under the first two seeds, words of the same length look alike."""

    def words_of(self, texts):
        hashes, begins = super().words_of(texts)
        if self.seed != substring.SEEDS[2]:
            hashes = np.array([len(w) for t in texts for w in t.split()], np.uint64)
        return hashes, begins


def test_words_decide_not_hashes(spark, monkeypatch):
    """What hashes match is compared as text; where words differ, the next seed is taken."""
    r = random.Random(9)
    passage = brute.made_up(r, 60)
    texts = [" ".join(brute.made_up(r, 50) + (passage if k % 3 == 0 else []) + brute.made_up(r, 30)) for k in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    wanted = brute.substring(texts)
    # Anchored itself, without Spark, under each seed
    data = [t.encode() for t in texts]
    for weak in (False, True):
        found = substring.Anchored(data, (_Weak if weak else substring.WordHasher)(61, lower=False))
        assert found.n_words.tolist() == [n for n, _, _ in wanted]
        for k in range(len(found.start)):
            assert len(found.windows_of(k)) == found.size[k]
    rows = substring.keyed(frame)
    scratch = substring.Scratch(spark)
    false = spark.createDataFrame([(0, 3, 1, 1, 4)], "key long, start int, size int, at_key long, at_start int")
    assert substring._verified(false, rows.select("key", "text"), scratch, 35) is None
    true = spark.createDataFrame([(0, 50, 26, 3, 50), (3, 50, 26, 3, 50)], "key long, start int, size int, at_key long, at_start int")
    gone = {x.key: x.gone for x in substring._verified(true, rows.select("key", "text"), scratch, 35).collect()}
    assert gone == {0: [50, 110], 3: [50, 110]}
    scratch.clear()
    tried, verified = [], substring._verified

    def once(*args):
        tried.append(verified(*args))
        return None if len(tried) == 1 else tried[-1]

    monkeypatch.setattr(substring, "_verified", once)
    got = sorted(substring.without_repeats(frame).select("doc_id", "n_words", "n_removed").collect())
    assert [tuple(x) for x in got] == [(k, n, m) for k, (n, m, _) in enumerate(wanted)] and len(tried) == 2
    monkeypatch.setattr(substring, "_verified", lambda *_: None)
    with pytest.raises(RuntimeError, match="every seed"):
        substring.without_repeats(frame, seeds=(61,))


def test_substring_by_small_parameters(spark, odd, odd_rows, monkeypatch):
    """Keys that are joined by a shuffle, hot anchors that are sent to all, many passages asked of one document."""
    import functools

    from pyspark.sql import functions as F

    from tidemill.llm import common

    monkeypatch.setattr(substring, "SEND_KEYS", 0)
    monkeypatch.setattr(substring, "CUTS", 2)
    monkeypatch.setattr(substring, "join_hot", functools.partial(common.join_hot, hot_part=0.0, hot_rows=4))
    found = substring.without_repeats(odd, batches=3).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    wanted = [(i, *x) for (i, _), x in zip(odd_rows, brute.substring([t for _, t in odd_rows]), strict=True)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_substring_over_block_edges():
    """Spans of a text of more windows than a block has are those of the plain rule."""
    r = random.Random(3)
    words = [f"{r.randrange(10**5)}" for _ in range(70_000)]
    hasher = substring.WordHasher(61, lower=False)
    found = substring.Anchored([b"short", " ".join(words).encode(), b""], hasher)
    assert found.size.sum() == 70_000 - 34 and set(found.text.tolist()) == {1}
    assert (np.diff(found.start) == found.size[:-1]).all() and found.start[0] == 0
    at = int(np.searchsorted(found.start, 65_536)) - 1
    near = substring.Anchored([" ".join(words[65_000:66_000]).encode()], hasher)
    assert found.sign[at] in near.sign and found.hash[at] in near.hash


def test_index_in_batches(spark, tmp_path):
    """Runs are merge-joined: what recurs in a later batch is found, also by an index opened anew, and compaction adds counts."""
    spans = lambda *x: spark.createDataFrame([(h, s, k, 0, 1) for k, (h, s) in enumerate(x)], substring._SPANS)
    heads = lambda frame: {r.h: (r.n, r.kinds) for r in frame.collect()}
    index = substring.FingerprintIndex(spark, str(tmp_path), buckets=3)
    assert heads(index.append(spans((1, 1), (2, 1), (2, 2)))) == {2: (2, 2)}
    index.commit()
    lost = substring.FingerprintIndex(spark, str(tmp_path))
    lost.append(spans((1, 1), (9, 9)))  # never committed
    again = substring.FingerprintIndex(spark, str(tmp_path))
    second = again.append(spans((1, 1), (5, 1)))
    assert heads(second) == {1: (2, 2)}
    again.commit("two")
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    index = substring.FingerprintIndex(spark, str(tmp_path))
    assert (index.labels, index.buckets, len(index.names)) == (["", "two"], 3, 2)
    index.fan_in = 2  # the next batch meets a compacted run
    assert heads(index.append(spans((5, 7), (6, 1)))) == {5: (2, 2)}
    assert len(index.names) == 1
    found = index.classes(spark.createDataFrame([(1, 2, 1), (5, 2, 2)], "h long, n long, kinds long")).collect()
    assert sorted((r.h, r.sign, r.n) for r in found) == [(1, 1, 2), (5, 1, 1), (5, 7, 1)]
    index.drop()


def _history(batches):
    """What each batch loses and keeps, by the plain rule: (n_words, n_removed, kept) by doc_id."""
    seen, out = set(), []
    for rows in batches:
        split = {k: brute.WORD.findall(t or "") for k, t in rows}
        windows = {k: [tuple(w[a : a + 35]) for a in range(len(w) - 34)] for k, w in split.items()}
        counts: dict = {}
        for w in (x for ws in windows.values() for x in ws):
            counts[w] = counts.get(w, 0) + 1
        gone = {k: {a + d for a, w in enumerate(windows[k]) if counts[w] > 1 or w in seen for d in range(35)} for k in split}
        out.append({k: (len(w), len(gone[k]), " ".join(x for a, x in enumerate(w) if a not in gone[k])) for k, w in split.items()})
        seen |= set(counts)
    return out


def _batches(seed):
    r = random.Random(seed)
    passages = [brute.made_up(r, 45) for _ in range(3)]
    return [[(k, " ".join(brute.made_up(r, 30) + (passages[(k + b) % 3] if b + k else []) + brute.made_up(r, 10 * k))) for k in range(4)] for b in range(3)]


def _added(cleaner, rows, name=None):
    frame = cleaner.spark.createDataFrame(rows, "doc_id long, text string")
    return {x.doc_id: (x.n_words, x.n_removed, x.kept) for x in cleaner.add(frame, name=name).collect()}


def test_batches_against_history(spark, tmp_path):
    """A second and third call clean new batches against all that is on disk, also after an empty batch."""
    batches = _batches(6)
    batches.insert(1, [])
    for rows, wanted in zip(batches, _history(batches), strict=True):
        found = _added(substring.IncrementalDedup(spark, str(tmp_path), fan_in=1), rows)
        assert found == wanted
    assert any(n for _, n, _ in found.values())


@pytest.mark.parametrize("step", ["_gone", "_write", "commit", "matched", "_keep"])
def test_a_batch_that_broke_off_is_added_again(spark, tmp_path, monkeypatch, step):
    """An add that fails at some step leaves the past as it was; done again, it gives the plain result."""
    owner = substring if step in ("_gone", "matched") else substring.FingerprintIndex
    works, batches = getattr(owner, step), _batches(7)[:2]

    def fails(*args, **more):
        raise OSError("lost")

    for number, (rows, wanted) in enumerate(zip(batches, _history(batches), strict=True)):
        monkeypatch.setattr(owner, step, fails)
        with pytest.raises(OSError, match="lost"):
            _added(substring.IncrementalDedup(spark, str(tmp_path)), rows)
        monkeypatch.setattr(owner, step, works)
        assert _added(substring.IncrementalDedup(spark, str(tmp_path)), rows, f"batch {number}") == wanted
        # its result was lost: by its name it isn't a new batch
        assert _added(substring.IncrementalDedup(spark, str(tmp_path)), rows, f"batch {number}") == wanted
    assert any(n for _, n, _ in wanted.values())


def test_names_of_helper_columns(spark):
    """Columns that have the helpers' names come back as they were."""
    rows = [(k, " ".join(f"w{j}" for j in range(40)), "a", "b", "c", "d") for k in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, repeat_key string, repeat_gone string, __key string, __sha string")
    left = substring.remove_repeats(frame).collect()
    assert sorted(tuple(x) for x in left) == [(k, "", "a", "b", "c", "d") for k in range(3)]


def test_empty_tables(nothing):
    assert exact.equal_groups(nothing).count() == 0
    assert exact.drop_copies(nothing).count() == 0
    assert neardup.near_groups(nothing).count() == 0
    assert substring.without_repeats(nothing).count() == 0
    assert substring.remove_repeats(nothing).columns == nothing.columns

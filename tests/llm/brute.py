"""Plain versions of the contracts, for small tables."""

import hashlib
import itertools
import re
import zlib

import numpy as np

WORD = re.compile(r"[^ \t-\r]+")


def crc(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(5)), strict=False))


def near_groups(rows, percent=85):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text), by comparing all that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    for a, b in {p for ids in by.values() for p in itertools.combinations(sorted(ids), 2)}:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def kept_words(texts, window=35):
    """For each text, its words and whether each goes."""
    split, seen = [WORD.findall(t or "") for t in texts], {}
    for words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for words in split:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if seen[tuple(words[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((words, gone))
    return out


def substring(texts, window=35):
    out = []
    for words, gone in kept_words(texts, window):
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def normal(text):
    return re.sub(r"[ \t-\r]+", " ", text or "")


def exact(rows):
    """Rows (doc_id, keep_id, group_size, kept, sha256), sorted."""
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[normal(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def packed_right(rows, ids_of, capacity=4096):
    """Checks piece rows against the ids of each doc_id (a list of bytes, repeated rows allowed); returns the number of sequences."""
    wanted = []
    for doc_id, ids in ids_of:
        for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at : at + 4 * capacity]
            wanted.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
    assert sorted(wanted, key=repr) == sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def mutated(words, random, share):
    words = list(words)
    for k in range(len(words)):
        if random.random() < share:
            words[k] = f"w{random.randrange(10**6)}"
    return words


def made_up(random, n):
    return [f"{random.choice('bcdfg')}{random.choice('aeiou')}{random.randrange(400)}" for _ in range(n)]


def rng(seed):
    return np.random.default_rng(seed)

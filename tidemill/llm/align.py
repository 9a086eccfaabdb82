"""Operator 12, alignment of two tokenizers by packed pair keys.

Every text is encoded by a byte-level BPE (A) and a piece BPE with byte
fallback (B). Where a token of A and one of B end at the same byte, the two are
linked, and these bytes cut both sequences into groups. A pair of ids is packed
into one int64, B's id in the upper half.

Counting: each task sums its pairs by ``np.unique`` in batches of bounded size;
the partial counts are range-partitioned and sorted by key over the cluster,
and each range sums its runs into one shard, two raw files of sorted keys and
their counts. Shards are memory-mapped by the tasks that look pairs up, by
``searchsorted``, so a task holds only the pages that it touches. As keys are
sorted by B's id first, the highest count of each id of B falls out of the same
pass, a few numbers a shard and at most B's vocabulary in all.

Neither tokenizer joins anything over a single space before a non-space (A's
pattern starts a match there, and no piece of B has a space behind another
character, which is checked), so both encode the parts between such spaces, and
the links of a part that was seen before come from a memo of bounded memory. A's
parts go through an encoder by ranks that is built from A's own file, if the
file shows that ids are ranks; else, through A itself.

Defined results: null and empty texts, and texts whose tokens don't join to
the space and the text (say, texts with U+2581), have zeros and an empty
digest; very long texts are encoded part by part; repeated rows count each
time; a null doc_id is kept.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.bpe import tokenizer_path
from tidemill.llm.common import Scratch, arrow_schema, delete, documents, id_and_text, map_rows, record_batch, shared_dir, staged

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Keys that a task holds before it sums them, and different ones before it sends them on.
BUFFER_KEYS, PARTIAL_KEYS = 1 << 21, 1 << 20
#: Bytes that each of a task's two memos holds, about; parts of more characters are never kept.
MEMO_BYTES, MEMO_PART = 40 << 20, 48
SPACE_MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes for bytes: printable ones are themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class TwoTokenizers:
    """Aligns parts of texts; a part is what follows a space up to the next cut."""

    _odd = re.compile(r" (?:\s|\Z)")
    _cut = re.compile(r"(?<=[^ ])(?= \S)")

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet, known = byte_alphabet(), self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (1 + max(known.values()))
        for token, k in known.items():
            self.a_bytes[k] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError("a piece goes on after a space: texts can't be cut at spaces")
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace(SPACE_MARK, " ").encode() for k, p in enumerate(pieces)]
        self.ids_of_a = self._by_ranks(a_path) or (lambda text: self.a.encode(text, add_special_tokens=False).ids)
        self.texts = [str(k) for k in range(max(len(self.a_bytes), len(pieces)))]
        self.memo: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.held = 0

    def _by_ranks(self, a_path: str):
        """A's encoder with ids as ranks, if its file says that this is the same: byte-level words and merges in the order of the ids they make."""
        import public_tokenizers
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            kept = json.load(file)
        model, cutter = kept["model"], kept["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        made = [model["vocab"].get("".join(m)) for m in merges]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")) and kept["normalizer"] is None
        words = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        single = sorted(k for k, t in enumerate(self.a_bytes) if len(t) == 1)
        if not (plain and words) or None in made or any(x >= y for x, y in zip(made, made[1:], strict=False)) or single != list(range(256)) or len(made) + 256 != len({t for t in self.a_bytes if t}):
            return None
        ranks = {t: k for k, t in enumerate(self.a_bytes) if t}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def align(self, part: str) -> tuple:
        """(tokens of A, tokens of B, groups as text, packed pairs) of a space and the part; text None if bytes don't join."""
        spaced = " " + part
        a, b, whole = self.ids_of_a(spaced), self.b.encode(part, num_threads=1), spaced.encode()
        of_a, of_b, texts = [self.a_bytes[k] for k in a], [self.b_bytes[k] for k in b], self.texts
        if b"".join(of_a) != whole or b"".join(of_b) != whole:
            return 0, 0, None, b""
        groups, pairs, j, at, end_a, end_b, first_a, first_b = [], [], 0, 0, 0, 0, 0, 0
        for token in of_a:
            at += 1
            end_a += len(token)
            while end_b < end_a:
                end_b += len(of_b[j])
                j += 1
            if end_a == end_b:
                if at - first_a == 1 and j - first_b == 1:
                    groups.append(f"{texts[a[first_a]]}|{texts[b[first_b]]}")
                else:
                    groups.append(",".join([texts[k] for k in a[first_a:at]]) + "|" + ",".join([texts[k] for k in b[first_b:j]]))
                pairs.append(b[j - 1] << 32 | a[at - 1])
                first_a, first_b = at, j
        return len(a), len(b), ";".join(groups), struct.pack(f"<{len(pairs)}q", *pairs)

    def _of(self, part: str) -> tuple:
        found = self.old.get(part) or self.align(part)
        if len(part) <= MEMO_PART:
            self.held += 400 + 2 * len(part) + len(found[3]) + len(found[2] or "")
            if self.held > MEMO_BYTES:  # what is asked for again comes back from the old memo
                self.old, self.memo, self.held = self.memo, {}, 0
            self.memo[part] = found
        return found

    def text(self, text: str) -> tuple[int, int, str, bytes]:
        """(tokens of A, tokens of B, groups as text, packed pairs) of a text; all empty where it has no tokens."""
        if not text:
            return 0, 0, "", b""
        if self._odd.search(text) or text[0] == " ":
            parts = [p[1:] for p in self._cut.split(" " + text)]
        else:
            parts = text.split(" ")
        memo, of = self.memo.get, self._of
        found = []
        for p in parts:
            x = memo(p)
            if x is None:
                x = of(p)
                memo = self.memo.get
            found.append(x)
        a, b, groups, pairs = zip(*found, strict=True)
        if None in groups:
            return 0, 0, "", b""
        return sum(a), sum(b), ";".join(groups), b"".join(pairs)


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, groups: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_links, groups_sha256, links binary, groups): links are packed int64 pairs, B's id in the upper half; groups is null unless asked for."""

    def make():
        both = TwoTokenizers(tokenizer_path(BYTE_BPE, a_path), tokenizer_path(PIECE_BPE, b_path))

        def run(batch: pa.RecordBatch) -> dict:
            a, b, text, links = zip(*map(both.text, batch.column(1).to_pylist()), strict=True)
            sha = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in text]
            return {"doc_id": batch.column(0), "n_a": a, "n_b": b, "n_links": [len(x) // 8 for x in links], "groups_sha256": sha, "links": links, "groups": text if groups else [None] * len(text)}

        return run

    return map_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, links binary, groups string", 256, text=1)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def partial_counts(links: DataFrame, buffer_keys: int = BUFFER_KEYS, partial_keys: int = PARTIAL_KEYS) -> DataFrame:
    """(pair, n): each task's pairs, summed in batches of bounded size."""
    ddl = "pair long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, parts, waiting = arrow_schema(ddl), [], 0
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], schema=schema)
        for batch in batches:
            for packed in batch.column(0):
                if packed.is_valid:
                    parts.append(np.frombuffer(packed.as_buffer(), "<i8"))
                    waiting += len(parts[-1])
                if waiting >= buffer_keys:
                    new, n = np.unique(np.concatenate(parts), return_counts=True)
                    keys, counts = summed(np.concatenate((keys, new)), np.concatenate((counts, n)))
                    parts, waiting = [], 0
                    if len(keys) >= partial_keys:
                        yield out()
                        keys, counts = keys[:0], counts[:0]
        if parts:
            new, n = np.unique(np.concatenate(parts), return_counts=True)
            keys, counts = summed(np.concatenate((keys, new)), np.concatenate((counts, n)))
        yield out()

    return links.select("links").mapInArrow(run, ddl)


def _file_system(uri: str):
    """(file system, path) of a folder of the shared store, without Spark."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if urlparse(uri).scheme else f"file://{os.path.abspath(uri)}")


_SHARD = "stem string, lo long, n long, ids binary, tops binary"


def count_shards(partial: DataFrame, folder: str, ranges: int) -> DataFrame:
    """Sorted count shards in a folder: a row (stem, lo, n, ids, tops) for each, with the highest count of each of its ids of B.

    A task that runs again writes files of its own; only those count whose row
    is returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, store, path = arrow_schema(_SHARD), *_file_system(folder)
        stem, lo, n, tops = f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}", None, 0, {}
        files: list = []

        def put(keys: np.ndarray, counts: np.ndarray) -> None:
            nonlocal lo, n
            if not len(keys):
                return
            if not files:
                lo = int(keys[0])
                files.extend(store.open_output_stream(f"{path}/{stem}.{kind}") for kind in ("keys", "counts"))
            n += len(keys)
            for file, values in zip(files, (keys, counts), strict=True):
                file.write(np.ascontiguousarray(values, "<i8").tobytes())
            ids = keys >> 32
            starts = np.flatnonzero(np.diff(ids, prepend=-1))
            for k, top in zip(ids[starts].tolist(), np.maximum.reduceat(counts, starts).tolist(), strict=True):
                tops[k] = max(tops.get(k, 0), top)

        last, total = np.empty(0, np.int64), np.empty(0, np.int64)  # the run that the next batch may go on with
        for batch in batches:
            if batch.num_rows:
                keys, counts = summed(np.concatenate((last, batch.column(0).to_numpy())), np.concatenate((total, batch.column(1).to_numpy())))
                put(keys[:-1], counts[:-1])
                last, total = keys[-1:], counts[-1:]
        put(last, total)
        for file in files:
            file.close()
        if files:
            ids, highest = np.array(sorted(tops), "<i8"), np.array([tops[k] for k in sorted(tops)], "<i8")
            yield record_batch([(stem, lo, n, ids.tobytes(), highest.tobytes())], schema)

    return partial.repartitionByRange(ranges, "pair").sortWithinPartitions("pair").mapInArrow(run, _SHARD)


class CountShards:
    """Looks packed pairs up in the shards of a folder, which are memory-mapped as they are needed."""

    def __init__(self, folder: str, shards: list[tuple[str, int, int]]):
        self.folder, self.shards = folder, sorted(shards, key=lambda s: s[1])
        self.lows = np.array([lo for _, lo, _ in self.shards], np.int64)
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _mapped(self, name: str, n: int) -> np.ndarray:
        store, path = _file_system(self.folder)
        if store.type_name == "local":
            return np.memmap(f"{path}/{name}", "<i8", "r", shape=(n,))
        with store.open_input_stream(f"{path}/{name}") as source, tempfile.TemporaryFile() as copy:  # has no name: goes with its last user
            while block := source.read(1 << 22):
                copy.write(block)
            copy.flush()
            return np.memmap(copy, "<i8", "r", shape=(n,))

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key; 0 for those that no shard has. The different keys are looked up once."""
        out, of = np.zeros(len(keys), np.int64), np.searchsorted(self.lows, keys, "right") - 1
        for k in np.unique(of[of >= 0]).tolist():
            if k not in self.open:
                stem, _, n = self.shards[k]
                self.open[k] = self._mapped(f"{stem}.keys", n), self._mapped(f"{stem}.counts", n)
            known, counts = self.open[k]
            mine = np.flatnonzero(of == k)
            at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
            out[mine] = np.where(known[at] == keys[mine], counts[at], 0)
        return out


def pair_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row for each document.

    n_best: links whose count is the highest of their B id's; count_sum: the
    counts over the links.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    folder = f"{shared_dir(spark)}/pair-counts-{uuid.uuid4().hex}"
    found = staged(aligned(docs, id_col, text_col, a_path, b_path, groups=False).drop("groups"), "links", scratch)
    try:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        store, path = _file_system(folder)
        store.create_dir(path)
        partial = staged(partial_counts(found), "partial", scratch)  # the sort reads it twice
        shards = staged(count_shards(partial, folder, ranges), "shards", scratch).collect()  # a row a range
        best = np.zeros(1 + max((int(np.frombuffer(s.ids, "<i8")[-1]) for s in shards), default=0), np.int64)  # by B's id
        for s in shards:
            ids = np.frombuffer(s.ids, "<i8")
            best[ids] = np.maximum(best[ids], np.frombuffer(s.tops, "<i8"))
        listed = [(s.stem, s.lo, s.n) for s in shards]

        def make():
            known = CountShards(folder, listed)

            def run(batch: pa.RecordBatch) -> dict:
                links = [np.frombuffer(x.as_buffer(), "<i8") for x in batch.column(5)]
                keys, back = np.unique(np.concatenate(links), return_inverse=True)
                counts = known.counts(keys)
                top = (counts == best[keys >> 32])[back] if len(keys) else np.empty(0, bool)
                edges = np.concatenate(([0], np.cumsum([len(x) for x in links])))
                sums = np.concatenate(([0], np.cumsum(counts[back])))[edges]
                tops = np.concatenate(([0], np.cumsum(top)))[edges]
                columns = dict(zip(("doc_id", "n_a", "n_b", "n_links", "groups_sha256"), batch.columns[:5], strict=True))
                return columns | {"n_groups": batch.column(3), "n_best": np.diff(tops), "count_sum": np.diff(sums)}

            return run

        ddl = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        return staged(map_rows(found, make, ddl, 512, text=5), "aligned")
    finally:
        scratch.clear()
        delete(spark, folder)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_statistics(documents(spark, sf_dir))


QUERIES = {"op12_align": op12_align}
ORACLE_SQL: dict[str, str] = {}

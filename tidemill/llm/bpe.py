"""Operator 10: byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end the
prefix's BPE encoding: the encoding of a longer prefix is that of a shorter
one plus one token, and two tokens may stand side by side exactly if BPE turns
their joined bytes into just these two. So one pass over the prefixes, keeping
the last token of each, encodes a piece; bytes can be appended without looking
at the old ones again, and after an edit only the prefixes near it change.

Defined results: a null or empty text has no ids and decodes to no bytes; very
long texts are encoded piece by piece with bounded memos; equal texts give
equal ids. Ids are packed as little-endian unsigned 32-bit integers in a binary
column (``unpack_ids`` gives arrays).
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import WordCache, documents, id_and_text, map_rows

#: The rank file's name among the public tokenizers.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Tokens whose joined bytes are tested at most so many pairs at a time.
PAIR_MEMO = 500_000
#: Prefixes of pieces of up to so many bytes whose last token is kept, so many of them.
MEMO_PIECE, PREFIX_MEMO = 64, 600_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PrefixEncoder:
    """BPE by ranks over single pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lengths = [len(t) for t in self.tokens]
        self.longest = max(map(len, ranks), default=0)
        self._pairs: dict[int, bool] = {}
        self._known: dict[bytes, int] = {}
        self._reachable: set[int] = set()
        self._halves: dict[int, tuple[int, int] | None] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Plain BPE: join the neighbours of least rank until none can be joined."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose join makes this one, (token, token) for a single byte, None if BPE never makes it."""
        if token not in self._halves:
            data = self.tokens[token]
            if len(data) == 1:
                halves = (token, token)
            else:
                ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
                while len(parts) > 2:
                    found = min(((r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
                    if found is None:
                        break
                    parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
                halves = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
            self._halves[token] = halves
            if halves:
                self._reachable.add(token)
        return self._halves[token]

    def _stand_together(self, first: int, second: int) -> bool:
        """Whether BPE of the two tokens' joined bytes gives just these two.

        Undoes the merges of both sides from the last to the first. If at some
        time the tokens that then met at the boundary could have been joined
        before the merge undone next, BPE would have crossed the boundary.
        Of equal ranks the left one is merged first.
        """
        key = first << 32 | second
        known = self._pairs.get(key)
        if known is not None:
            return known
        tokens, ranks = self.tokens, self.ranks
        left, right, before, answer = first, second, len(tokens) + 1, None
        while answer is None:
            joined = ranks.get(tokens[left] + tokens[right])
            # a join across the boundary comes after an equal merge on its left, before one on its right
            if joined is not None and joined < before:
                answer = False
            else:
                left_open, right_open = len(tokens[left]) > 1, len(tokens[right]) > 1
                if not left_open and not right_open:
                    answer = True
                elif left_open and (left > right or not right_open):
                    before, left = left, self._split(left)[1]
                else:
                    before, right = right + 1, self._split(right)[0]
        if len(self._pairs) >= PAIR_MEMO:
            self._pairs.clear()
        self._pairs[key] = answer
        return answer

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The token that ends the encoding of data[:end], given those of all shorter prefixes."""
        ranks = self.ranks
        for start in range(max(0, end - self.longest), end):
            token = ranks.get(data[start:end])
            if token is not None and self._split(token) and (not start or self._stand_together(last[start], token)):
                return token
        raise ValueError("a byte has no token of its own")

    def prefixes(self, piece: bytes) -> list[int]:
        """last[i]: the token that ends the encoding of piece[:i]; last[0] is -1."""
        last = [-1]
        for end in range(1, len(piece) + 1):
            last.append(self.last_token(piece, end, last))
        return last

    def walk_back(self, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end])
            end -= self.lengths[last[end]]
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)  # a piece that is a token stays one, reachable or not
        if whole is not None:
            return [whole]
        if len(piece) > MEMO_PIECE:
            return self.walk_back(self.prefixes(piece), len(piece))
        # pieces share prefixes: each prefix's last token is kept by its bytes
        known, rank_of, pairs, reachable, longest = self._known, self.ranks.get, self._pairs, self._reachable, self.longest
        if len(known) > PREFIX_MEMO:
            known.clear()
        done = size = len(piece)
        while done and piece[:done] not in known:
            done -= 1
        last = [-1] * (size + 1)  # filled from the memo where needed
        for end in range(done + 1, size + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = rank_of(piece[start:end])
                if token is None or token not in reachable and not self._split(token):
                    continue
                if start:
                    before = last[start]
                    if before < 0:
                        before = last[start] = known[piece[:start]]
                    good = pairs.get(before << 32 | token)
                    if good is None:
                        good = self._stand_together(before, token)
                    if not good:
                        continue
                last[end] = known[piece[:end]] = token
                break
            else:
                raise ValueError("a byte has no token of its own")
        out, end, lengths = [], size, self.lengths
        while end:
            token = last[end]
            if token < 0:
                token = known[piece[:end]]
            out.append(token)
            end -= lengths[token]
        return out[::-1]

    def decode(self, ids: Iterable[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class EditablePiece:
    """A piece whose encoding follows appends and edits.

    ``append`` looks only at the new bytes. ``replace`` recomputes prefixes
    from the edit on and stops as soon as a full token length of them agrees
    with the old ones: from there on all later ones must agree too.
    """

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.data, self.last, self.recomputed = encoder, b"", [-1], 0
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.data += more
        while len(self.last) <= len(self.data):
            self.last.append(self.encoder.last_token(self.data, len(self.last), self.last))

    def replace(self, start: int, end: int, new: bytes) -> None:
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, agreed, self.recomputed = old[: start + 1], 0, 0
        while len(self.last) <= len(self.data):
            at = len(self.last)
            if agreed >= self.encoder.longest:
                self.last += old[at - shift :]
                break
            token = self.encoder.last_token(self.data, at, self.last)
            self.recomputed += 1
            self.last.append(token)
            same = at - shift > end and token == old[at - shift] and at - len(self.encoder.tokens[token]) >= start + len(new)
            agreed = agreed + 1 if same else 0

    def tokens(self) -> list[int]:
        if not self.data:
            return []
        whole = self.encoder.ranks.get(self.data)
        return [whole] if whole is not None else self.encoder.walk_back(self.last, len(self.data))


class TextEncoder:
    """Whole texts: the pattern's matches, each encoded on its own.

    No match of the pattern reaches over the start of a space before a
    non-space, so texts are cut there and the ids of short parts are kept in
    memos of bounded memory.
    """

    _odd = re.compile(r" (?:\s|\Z)")
    _cut = re.compile(r"(?= \S)")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.encoder, self.find = PrefixEncoder(ranks), regex.compile(pattern).findall
        self.pieces = WordCache(self._piece)
        self.first = WordCache(self._part, 8 << 20)
        self.spaced = WordCache(self._spaced)
        #: a space and letters are one match of the pattern
        self.plain = r"| ?\p{L}+|" in pattern
        self.others = WordCache(self._part, 8 << 20)

    def _piece(self, piece: str) -> bytes:
        ids = self.encoder.encode_piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[p] for p in self.find(part)])

    def _spaced(self, part: str) -> bytes:
        if part.isalpha() and self.plain:
            return self._piece(" " + part)
        return self._part(" " + part)

    def encode(self, text: str) -> bytes:
        """Ids, packed as little-endian unsigned 32-bit integers."""
        if self._odd.search(text):
            others = self.others
            return b"".join([others[p] for p in self._cut.split(text)])
        head, *parts = text.split(" ")
        spaced = self.spaced
        return self.first[head] + b"".join([spaced[p] for p in parts])


def tokenizer_path(name: str = RANKS, path: str | None = None) -> str:
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids binary) of every text."""

    def make():
        if pattern is None:
            import public_tokenizers

            encoder = TextEncoder(load_ranks(tokenizer_path(path=path)), public_tokenizers.PATTERN)
        else:
            encoder = TextEncoder(load_ranks(tokenizer_path(path=path)), pattern)

        def run(batch: pa.RecordBatch) -> dict:
            ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            return {"doc_id": batch.column(0), "n_tokens": [len(i) // 4 for i in ids], "ids": ids}

        return run

    return map_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, n_tokens long, ids binary", 256, text=1)


def decode_ids(frame: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded binary) of (doc_id, n_tokens, ids); null ids decode to null."""

    def make():
        encoder = PrefixEncoder(load_ranks(tokenizer_path(path=path)))

        def run(batch: pa.RecordBatch) -> dict:
            packed = batch.column(2).to_pylist()
            return {
                "doc_id": batch.column(0),
                "n_tokens": batch.column(1),
                "ids": batch.column(2),
                "decoded": [None if p is None else encoder.decode(np.frombuffer(p, "<u4").tolist()) for p in packed],
            }

        return run

    return map_rows(frame.select("doc_id", "n_tokens", "ids"), make, "doc_id long, n_tokens long, ids binary, decoded binary", 256)


def unpack_ids(ids: Column) -> Column:
    """Packed ids as array<long>, with built-in functions only."""
    # slices of a binary cost their own length only, so long columns stay linear
    byte = lambda i, k: F.hex(F.substring(ids, i * 4 + 1 + k, F.lit(1)))
    number = lambda i: F.conv(F.concat(byte(i, 3), byte(i, 2), byte(i, 1), byte(i, 0)), 16, 10).cast("long")
    places = F.sequence(F.lit(0), (F.length(ids) / 4).cast("int") - 1)
    return F.when(F.length(ids) > 0, F.transform(places, number)).otherwise(F.array().cast("array<long>"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode_ids(encode_texts(documents(spark, sf_dir)))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op10_bpe": op10_bpe}
ORACLE_SQL: dict[str, str] = {}

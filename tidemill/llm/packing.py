"""Operator 7, best-fit packing: minimum bin slack over token sequences.

Every document's ids, closed by an end id, are cut into pieces of at most
``capacity`` tokens. Per bin, the longest piece left is taken and a bitset
subset-sum over the lengths still available finds the fullest combination that
fits beside it; what was found is removed and the next bin begins. Only the
number of pieces of each length matters for that, so the plan is made from a
histogram of at most ``capacity`` rows, and a combination is used as often as
its lengths last: the work on the driver is bounded by the capacity, not by
the corpus. Pieces then find their place by their rank among those of their
length; ranks come from cells of bounded size, and the cells' offsets from blocks
of them, so a common length is split at both levels.

Defined results: a null or empty text is one piece that holds the end id only;
very long texts are cut into full pieces and a rest; repeated rows are packed
each on its own, and which of two rows with equal doc_id and piece comes first is
open; an empty table gives no piece.
"""

from __future__ import annotations

import itertools
import re
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import documents, id_and_text, map_rows, staged
from tidemill.llm.sharding import CELLS, cell_offsets

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Rows of one length that are ranked in one task.
CELL_ROWS = 1024
#: Bytes of words and ids that a task remembers, about; the memo starts over when it is full. Longer words are not kept.
WORD_MEMO, LONGEST = 160 << 20, 64


class WordTokenizer:
    """Ids of whole texts from a tokenizer that drops white space.

    Neither its pattern nor its special tokens reach over white space, so a
    text's ids are those of its words one after the other. Words not yet known
    are encoded together. Most words are plain: normalising only lower-cases
    them. These are cut by the tokenizer's pattern here, and its own model
    gives the ids of each piece; all other words go through the whole tokenizer.
    """

    #: What the tokenizer's \\s holds, and Python's split() holds besides.
    _spaces = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
    _not_spaces = re.compile("[\x1c-\x1f]")

    #: Words that normalising leaves alone but for lower case, without numbers other than digits.
    _plain = re.compile("[!-~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f]+")
    #: The tokenizer's pattern, for such words.
    _pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, path: str, memo: int = WORD_MEMO):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or "(?!)")
        # the byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
        self.known: dict[str, bytes] = {}
        self.memo, self.held = memo, 0

    def words(self, text: str) -> list[str]:
        if self._not_spaces.search(text):
            return [w for w in self._spaces.split(text) if w]
        return text.split()

    def _piece(self, piece: str) -> list[int]:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(piece)]

    def _learn_plain(self, words: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        for word in words:
            ids = [i for piece in self._pieces.findall(word.lower()) for i in self._piece(piece)]
            found[word] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _learn_others(self, words: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        for first in range(0, len(words), 20_000):
            part = words[first : first + 20_000]
            starts = np.cumsum([0, *[len(w) + 1 for w in part]])
            coded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            at = np.fromiter(itertools.chain.from_iterable(coded.offsets), np.int64, 2 * len(coded.ids))[::2]
            ids, bounds = np.array(coded.ids, "<u4").tobytes(), (4 * np.searchsorted(at, starts)).tolist()
            for word, a, b in zip(part, bounds, bounds[1:], strict=False):
                found[word] = ids[a:b]
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        if self.held > self.memo:
            self.known.clear()
            self.held = 0
        split = [self.words(t) for t in texts]
        new = set(itertools.chain.from_iterable(split)).difference(self.known)
        plain = [w for w in new if self._plain.fullmatch(w) and not self.special.search(w)]
        found = self._learn_plain(plain)
        if len(plain) < len(new):
            found |= self._learn_others([w for w in new if w not in found])
        short = {w: ids for w, ids in found.items() if len(w) <= LONGEST}
        self.known |= short
        self.held += sum(map(len, short)) * 2 + 200 * len(short)
        long = found if len(short) < len(found) else None
        ids_of = self.known.__getitem__ if long is None else lambda w: long.get(w) or self.known.get(w, b"")
        return [b"".join(map(ids_of, words)) for words in split]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids binary) of every document."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        import public_tokenizers

        tokenizer = WordTokenizer(path or public_tokenizers.path(TOKENIZER))
        end = np.array([end_id], "<u4").tobytes()

        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids")}
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.encode_all(batch.column(1).to_pylist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for key, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, part), strict=True):
                        out[key].append(value)
            return out

        return run

    return map_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, piece int, start long, length long, ids binary", 512, text=1)


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The combination of (length, count), lengths descending, that fills the room best."""
    reach, full, steps = 1, (1 << room + 1) - 1, []
    for length, count in available:
        if length > room:
            continue
        left, chunk = min(count, room // length), 1
        while left and not reach >> room & 1:
            chunk = min(chunk, left)
            steps.append((length, chunk, reach))
            reach |= reach << length * chunk & full
            left -= chunk
            chunk *= 2
        if reach >> room & 1:
            break
    best, out = reach.bit_length() - 1, {}
    for length, chunk, before in reversed(steps):
        if best and not before >> best & 1:
            best -= length * chunk
            out[length] = out.get(length, 0) + chunk
    return out


def slack_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(combination {length: copies}, times)] by minimum bin slack."""
    left = {length: count for length, count in sorted(histogram.items(), reverse=True) if count}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    plan = []
    while left:
        longest = next(iter(left))
        rest = [(length, count - (length == longest)) for length, count in left.items()]
        found = fullest([x for x in rest if x[1]], capacity - longest)
        found[longest] = found.get(longest, 0) + 1
        times = min(left[length] // copies for length, copies in found.items())
        plan.append((found, times))
        for length, copies in found.items():
            left[length] -= copies * times
            if not left[length]:
                del left[length]
    return plan


def placements(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, copies, first sequence, first offset), by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for found, times in plan:
        offset = 0
        for length in sorted(found, reverse=True):
            copies = found[length]
            rows.append((length, used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + copies * times
            offset += length * copies
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY, cell_rows: int = CELL_ROWS, block: int = CELLS) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length.

    The rows are read several times: give a staged frame.
    """
    spark = pieces.sparkSession
    histogram = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = placements(slack_plan(histogram, capacity))
    cells_of = spark.createDataFrame([(n, -(-c // cell_rows)) for n, c in histogram.items()], "length long, _cells long")
    celled = pieces.join(F.broadcast(cells_of), "length").withColumn("_cell", F.pmod(F.xxhash64("doc_id", "piece"), "_cells"))
    offsets = cell_offsets(celled, "length", block=block)  # one row for each length and each cell_rows pieces; the join and the ranks share one shuffle
    within = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece")
    ranked = celled.join(offsets, ["length", "_cell"]).withColumn("_rank", F.col("_before") + F.row_number().over(within) - 1)
    keys = (table[:, 0] << 44) + table[:, 1]
    names = [c for c in pieces.columns]
    plain = {"bigint": "long"}
    schema = ", ".join(f"{f.name} {plain.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in pieces.schema) + ", sequence_id long, offset long"

    def make() -> Callable[[pa.RecordBatch], dict]:
        def run(batch: pa.RecordBatch) -> dict:
            out: dict = {name: batch.column(k) for k, name in enumerate(names)}
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (names.index("length"), len(names)))
            row = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            nth = rank - row[:, 1]
            out["sequence_id"] = row[:, 3] + nth // row[:, 2]
            out["offset"] = row[:, 4] + nth % row[:, 2] * length
            return out

        return run

    return map_rows(ranked.select(*names, "_rank"), make, schema, 8192)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise and pack; keep_ids also returns the packed ids themselves."""
    pieces = token_pieces(docs, id_col, text_col, path, capacity).withColumn("ids_crc32", F.crc32("ids"))
    return pack(staged(pieces if keep_ids else pieces.drop("ids"), "pieces"), capacity)


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op7_pack": op7_pack}
ORACLE_SQL: dict[str, str] = {}

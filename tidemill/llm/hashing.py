"""Vectorised 64-bit hashes of words and of runs of words, the same on every machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from tidemill.llm.common import SPACES

_MASK = (1 << 64) - 1
#: Texts are hashed in segments of about so many bytes, cut at white space.
SEGMENT = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64


def _numbers(seed: int, n: int) -> np.ndarray:
    """n well-mixed numbers (splitmix64)."""
    out = []
    for _ in range(n):
        seed = (seed + 0x9E3779B97F4A7C15) & _MASK
        z = seed
        z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & _MASK
        out.append(z ^ z >> 31)
    return np.array(out, np.uint64)


_IN_WORD = np.ones(256, bool)
_IN_WORD[[ord(c) for c in SPACES]] = False
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Of the eight bytes from a place on, those that belong to a word of so many bytes left.
_LANES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class WordHasher:
    """Hashes of words ``[^\\x20\\x09-\\x0D]+``.

    Eight bytes of a word at a time are added to a state that is then mixed by
    a bijection, so words of up to eight bytes never collide; long words take
    xxHash. Every byte and the length enter under the seed. Equal hashes are
    candidates only: what must be equal is compared as text by the callers.
    """

    def __init__(self, seed: int, lower: bool):
        self.seed, self.lower = seed, lower
        self.steps = _numbers(seed + 1, 64) | np.uint64(1)
        self._start = _numbers(seed, 2)

    def _segment(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first bytes) of the words of a segment."""
        data = np.frombuffer(b" " + text + b" " * 8, np.uint8)
        inside = _IN_WORD[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        with np.errstate(over="ignore"):
            out = mix((lanes[starts] & _LANES[np.minimum(sizes, 8)]) + self._start[0] + sizes.astype(np.uint64) * self._start[1])
            left = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
            at = 8
            while len(left):
                rest = sizes[left] - at
                out[left] = mix(out[left] + (lanes[starts[left] + at] & _LANES[np.minimum(rest, 8)]))
                left, at = left[rest > 8], at + 8
        for k in np.flatnonzero(sizes > LONG_WORD).tolist():
            first = int(starts[k]) - 1
            out[k] = xxhash.xxh3_64_intdigest(text[first : first + int(sizes[k])], self.seed)
        return out, starts - 1

    def _segments(self, text: bytes) -> Iterator[tuple[bytes, int]]:
        """(segment, its first byte), cut behind words."""
        if self.lower:
            text = text.translate(_LOWER)
        at = 0
        while len(text) - at > SEGMENT:
            end = at + SEGMENT
            while end < len(text) and _IN_WORD[text[end]]:
                end += 1
            yield text[at:end], at
            at = end
        yield text[at:], at

    def words(self, text: bytes) -> np.ndarray:
        return np.concatenate([self._segment(part)[0] for part, _ in self._segments(text)])

    def words_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts in one array, and where each text's words begin (and the last one's end)."""
        found = [(hashes, places + at) for part, at in self._segments(b" ".join(texts)) for hashes, places in [self._segment(part)]]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.concatenate(([0], np.cumsum(lengths)))
        return np.concatenate([h for h, _ in found]), np.searchsorted(np.concatenate([p for _, p in found]), begins)

    def runs(self, words: np.ndarray, size: int, shift: int = 0) -> np.ndarray:
        """The hash of each run of ``size`` consecutive words, by start; another shift gives another hash."""
        n = len(words) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total += words[k : k + n] * self.steps[(1 + k + shift) % len(self.steps)]
        return mix(total)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit of the input moves every bit of the output."""
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)

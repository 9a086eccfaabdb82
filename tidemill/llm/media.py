"""Operator 9, media columns: documents as PNG images in binary columns.

A payload is stored as an 8-bit greyscale PNG of 64 pixels a row. Reading
checks the signature and every chunk's CRC, inflates the data and undoes all
five row filters with numpy. The feature is a low-frequency cosine-transform
hash of the image: the 8 x 8 lowest coefficients without the constant one,
each compared with their median.

Defined results: a null or empty text is 64 zero bytes; very long texts make
tall images; equal texts give equal values; a damaged image raises ValueError.
A null media value gives null payload and feature.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents, id_and_text, map_rows

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
LOW = 8
#: Heights up to which the tables of cosines are kept, so that a task's 512 tables take 16 MB at most.
SMALL = 512


def pad_payload(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return data + b"\0" * (-len(data) % WIDTH or (0 if data else WIDTH))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def _filtered(rows: np.ndarray, kind: int) -> np.ndarray:
    """Rows under filter 0 (none), 1 (left) or 2 (above)."""
    out = rows.copy()
    if kind == 1:
        out[:, 1:] -= rows[:, :-1]
    elif kind == 2:
        out[1:] -= rows[:-1]
    return out


def png_encode(payload: bytes, width: int = WIDTH, level: int = 6) -> bytes:
    """8-bit greyscale PNG of a payload whose length is a positive multiple of width."""
    if not payload or len(payload) % width:
        raise ValueError("the payload must be a positive multiple of the row width")
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    # the usual choice: the filter with the least sum of absolute differences
    kinds = [(int(np.abs(_filtered(rows, k).view(np.int8).astype(np.int16)).sum()), k) for k in (0, 1, 2)]
    kind = min(kinds)[1]
    lines = np.empty((len(rows), width + 1), np.uint8)
    lines[:, 0] = kind
    lines[:, 1:] = _filtered(rows, kind)
    header = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def _unfilter(lines: np.ndarray) -> np.ndarray:
    """Undo the five filters; runs of one filter are undone at once."""
    kinds, data = lines[:, 0], lines[:, 1:]
    out = np.empty_like(data)
    above = np.zeros(data.shape[1], np.uint8)
    edges = np.flatnonzero(np.diff(kinds)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(kinds)], strict=True):
        kind, part = int(kinds[start]), data[start:end]
        if kind == 0:
            out[start:end] = part
        elif kind == 1:
            out[start:end] = np.cumsum(part, axis=1, dtype=np.uint8)
        elif kind == 2:
            out[start:end] = np.cumsum(part, axis=0, dtype=np.uint8) + above
        elif kind in (3, 4):
            out[start:end] = _undo_diagonals(part, above, kind)
        else:
            raise ValueError(f"unknown row filter {kind}")
        above = out[end - 1]
    return out


def _undo_diagonals(part: np.ndarray, above: np.ndarray, kind: int) -> np.ndarray:
    """Rows under filter 3 (average) or 4 (Paeth): a sample needs those on its left and above, so one diagonal follows the other."""
    n, width = part.shape
    done = np.zeros((n + 1, width + 1), np.int16)  # a row above, a column of zeros on the left
    done[0, 1:] = above
    for diagonal in range(n + width - 1):
        rows = np.arange(max(0, diagonal - width + 1), min(n, diagonal + 1))
        columns = diagonal - rows
        left, up, corner = done[rows + 1, columns], done[rows, columns + 1], done[rows, columns]
        if kind == 3:
            near = (left + up) >> 1
        else:
            guess = left + up - corner
            to_left, to_up, to_corner = np.abs(guess - left), np.abs(guess - up), np.abs(guess - corner)
            near = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
        done[rows + 1, columns + 1] = (part[rows, columns] + near) & 255
    return done[1:, 1:].astype(np.uint8)


def png_decode(data: bytes) -> np.ndarray:
    """The samples of an 8-bit greyscale PNG, as rows; ValueError if anything doesn't fit."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, packed, shape, kinds = 8, [], None, []
    while kinds[-1:] != [b"IEND"]:
        if at + 12 > len(data):
            raise ValueError("cut off within a chunk")
        (size,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        if at + 12 + size > len(data):
            raise ValueError("cut off within a chunk")
        body = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", data, at + 8 + size)[0]:
            raise ValueError(f"wrong checksum of chunk {kind!r}")
        if (kind == b"IHDR") != (not kinds):
            raise ValueError("the header must come first, and once")
        if kind == b"IHDR":
            if size != 13:
                raise ValueError("a header has 13 bytes")
            width, height, *rest = struct.unpack(">IIBBBBB", body)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("only plain 8-bit greyscale is read")
            if not width or not height:
                raise ValueError("an image has at least one sample")
            shape = height, width
        elif kind == b"IDAT":
            if packed and kinds[-1] != b"IDAT":
                raise ValueError("the data chunks must follow each other")
            packed.append(body)
        elif kind != b"IEND" and kind[:1].isupper():
            raise ValueError(f"unknown critical chunk {kind!r}")
        kinds.append(kind)
        at += 12 + size
    if at != len(data):
        raise ValueError("bytes behind the end")
    wanted, inflate = shape[0] * (shape[1] + 1), zlib.decompressobj()
    try:
        raw = inflate.decompress(b"".join(packed), wanted + 1)  # no more than the image may hold
    except zlib.error as error:
        raise ValueError(str(error)) from error
    if len(raw) != wanted or not inflate.eof:
        raise ValueError("the data don't fill the image")
    return _unfilter(np.frombuffer(raw, np.uint8).reshape(shape[0], shape[1] + 1))


def _cosines(n: int) -> np.ndarray:
    """The first LOW rows of the orthonormal cosine transform over n samples; small tables are kept."""
    return _small_cosines(n) if n <= SMALL else _made_cosines(n)


@lru_cache(maxsize=512)
def _small_cosines(n: int) -> np.ndarray:
    return _made_cosines(n)


def _made_cosines(n: int) -> np.ndarray:
    k, x = np.arange(LOW)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * n)) * np.sqrt(2 / n)


def cosine_hash(image: np.ndarray) -> str:
    """16 hexadecimal digits: the low coefficients against their median."""
    low = _cosines(image.shape[0]) @ image.astype(np.float64) @ _cosines(image.shape[1]).T
    low = np.round(low.ravel()[1:], 6)
    bits = low > np.median(low)
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = 6) -> DataFrame:
    """(doc_id, n_bytes, media binary): every text as a PNG."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            return {
                "doc_id": batch.column(0),
                "n_bytes": [len(t) for t in texts],
                "media": [png_encode(pad_payload(t), WIDTH, level) for t in texts],
            }

        return run

    return map_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, n_bytes long, media binary", 256, text=1)


def read_media(frame: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media, payload binary, feature string) of (doc_id, n_bytes, media)."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            images = [None if m is None else png_decode(m) for m in batch.column(2).to_pylist()]
            return {
                "doc_id": batch.column(0),
                "n_bytes": batch.column(1),
                "media": batch.column(2),
                "payload": [None if i is None else i.tobytes() for i in images],
                "feature": [None if i is None else cosine_hash(i) for i in images],
            }

        return run

    return map_rows(frame.select("doc_id", "n_bytes", "media"), make, "doc_id long, n_bytes long, media binary, payload binary, feature string", 256)


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_media(encode_media(documents(spark, sf_dir)))
    return stored.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


QUERIES = {"op9_media": op9_media}
ORACLE_SQL: dict[str, str] = {}

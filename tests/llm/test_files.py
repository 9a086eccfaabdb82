"""Sharding, packing, media and tokens."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemill.llm import bpe, media, packing, sharding

public_tokenizers = pytest.importorskip("public_tokenizers")


# sharding


def test_differencing_is_close():
    r = random.Random(1)
    sizes = [r.randrange(1, 10_000) for _ in range(500)] + [60_000]
    part = sharding.difference(sizes, 8)
    sums = [sum(s for s, p in zip(sizes, part, strict=True) if p == k) for k in range(8)]
    assert max(sums) - min(sums) <= 20
    assert sharding.difference([], 8) == [] and sharding.difference([5], 3) == [0]
    two = sharding.difference([8, 7, 6, 5, 4], 2)
    assert abs(sum(s if p else -s for s, p in zip([8, 7, 6, 5, 4], two, strict=True))) == 2


@pytest.mark.parametrize("law", ["bytes", "rows", "key"])
def test_shards_of_odd_rows(odd, odd_rows, law):
    rows = sharding.shard_documents(odd, law).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_rows if i is not None)
    assert len(rows) == len(odd_rows) and {r.law for r in rows} == {law}
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    if law == "bytes":
        of = {}
        for r in rows:
            assert of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
        assert all(r.grown_shard is None for r in rows)
    if law == "rows":
        counts = [len(by.get(k, [])) for k in range(8)]
        assert max(counts) - min(counts) <= 1
    if law == "key":
        assert all(r.grown_shard in (r.shard, 8) for r in rows)


def _plain_difference(sizes, parts):
    """Differencing as it is defined, on lists of sets."""
    nodes = [[(s, [k])] + [(0, [])] * (parts - 1) for k, s in enumerate(sizes)]
    while len(nodes) > 1:
        nodes.sort(key=lambda n: n[-1][0] - n[0][0])
        a, b = nodes.pop(0), nodes.pop(0)
        nodes.append(sorted([(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b), strict=True)], key=lambda p: -p[0]))
    return nodes[0]


def _spread(rows):
    """Bytes between the largest and the smallest of 8 shards, by plain differencing of all groups."""
    by = {}
    for _, t in rows:
        by[t or ""] = by.get(t or "", 0) + len((t or "").encode()) + 1
    sizes = list(by.values())
    sums = np.bincount(sharding.difference(sizes, 8), sizes, 8)
    return int(sums.max() - sums.min())


@pytest.mark.parametrize("parts", [1, 2, 3, 8, 40])
def test_differencing_is_the_plain_one(parts):
    r = random.Random(parts)
    for n, top in ((1, 50), (2, 50), (parts, 50), (3 * parts + 1, 50), (90, 50), (90, 1), (200, 1)):
        sizes = r.sample(range(1, 10**6), n)  # without ties every step is determined
        sizes[0] *= top
        part, plain = sharding.difference(sizes, parts), _plain_difference(sizes, parts)
        sums = sorted(np.bincount(part, sizes, parts).astype(int).tolist(), reverse=True)
        assert sums[0] - sums[-1] == plain[0][0] - plain[-1][0]


def test_shards_by_a_tree_of_buckets(spark):
    """Small buckets: several levels of bundles, hot groups, many cells; groups stay whole and shards nearly equal."""
    r = random.Random(2)
    texts = ["x" * r.randrange(1, 400) + str(k) for k in range(3000)] + ["the same " * 40] * 200
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard_documents(frame, slot_rows=100, bucket_groups=300, each=40, bundles=60, singles=100).collect()
    assert sorted(x.doc_id for x in rows) == list(range(3200)) and len({x.shard for x in rows if x.doc_id >= 3000}) == 1
    sums = np.bincount([x.shard for x in rows], [x.size for x in rows], 8)
    assert sums.max() - sums.min() <= _spread(list(enumerate(texts))) + 8
    for law in ("rows", "key"):
        rows = sharding.shard_documents(frame, law, slot_rows=3).collect()
        for k in range(8):
            slots = sorted(x.slot for x in rows if x.shard == k)
            assert slots == list(range(len(slots)))


def test_names_are_confirmed(spark):
    from tidemill.llm.common import confirm_names

    confirm_names(spark.createDataFrame([(b"a", b"x"), (b"a", b"x"), (b"b", b"y")], "name binary, body binary"))
    with pytest.raises(RuntimeError, match="SHA-256"):
        confirm_names(spark.createDataFrame([(b"a", b"x"), (b"a", b"y")], "name binary, body binary"))


def test_shard_query(spark, sf_dir, documents_here):
    rows = sharding.op4_shards(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in documents_here)
    sums = np.bincount([r.shard for r in rows], [r.size for r in rows], 8)
    assert sums.max() - sums.min() <= _spread(documents_here) + 4
    assert all(sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows))) for k in range(8))


def test_shards_of_nothing(nothing):
    assert sharding.shard_documents(nothing).count() == 0


# packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_word_ids_are_the_tokenizers(tokenizer, documents_here):
    own = packing.WordTokenizer(public_tokenizers.path(packing.TOKENIZER))
    r = random.Random(3)
    letters = list("ab é\n\t.,'sß日\x1c3٤²½xyzΣσİ́e\xa0\x85 ​DON'T|<>_-") + ["<|endoftext|>", "'ll", "'re"]
    texts = [t or "" for _, t in documents_here] + ["".join(r.choice(letters) for _ in range(r.randrange(30))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_special_tokens_and_long_words(tokenizer):
    """Special tokens are the tokenizer's, within words too; words too long to keep are encoded all the same."""
    own = packing.WordTokenizer(public_tokenizers.path(packing.TOKENIZER), memo=100)
    texts = ["a <|endoftext|> b", "x<|startoftext|>y<|ENDOFTEXT|>", "<|endoftext|", "long " + "abc" * 400 + " x", "é" * 90 + " été <|endoftext|>", "", "  ", "long again " + "abc" * 400]
    assert np.frombuffer(own.encode_all(texts[:1])[0], "<u4").tolist() == [320, 49407, 321]
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(len(w) <= packing.LONGEST for w in own.known)


def test_vocabulary_by_both_ways():
    own = packing.WordTokenizer(public_tokenizers.path(packing.TOKENIZER))
    r = random.Random(5)
    parts = [t.removesuffix("</w>") for t in own.tokenizer.get_vocab() if t.isascii()]
    words = list({w for w in parts + ["".join(r.choice(parts) for _ in range(r.randrange(1, 5))) for _ in range(20_000)] if own._plain.fullmatch(w) and not own.special.search(w)})
    assert own._learn_plain(words) == own._learn_others(words)


def test_fullest_against_all_subsets():
    r = random.Random(2)
    for _ in range(100):
        have = [(length, r.randrange(1, 4)) for length in sorted(r.sample(range(1, 40), 5), reverse=True)]
        room = r.randrange(1, 90)
        sums = {0}
        for length, n in have:
            sums |= {s + k * length for s in sums for k in range(1, n + 1) if s + k * length <= room}
        found = packing.fullest(have, room)
        assert sum(k * v for k, v in found.items()) == max(sums)
        assert all(v <= dict(have)[k] for k, v in found.items())


def test_pack_query(spark, sf_dir, documents_here, tokenizer):
    rows = packing.op7_pack(spark, sf_dir).collect()
    ids = [(i, _ids(tokenizer, t)) for i, t in documents_here]
    sequences = brute.packed_right(rows, ids)
    assert sequences <= -(-sum(len(x) // 4 for _, x in ids) // 4096) + 2


def test_pack_a_common_length(spark):
    """Many cells and blocks of one length: all places are taken once, without gaps."""
    pieces = spark.range(0, 5000, 1, 6).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 50 == 0, 7).otherwise(300).cast("long").alias("length"))
    rows = packing.pack(pieces, cell_rows=8, block=3).collect()
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert len(rows) == 5000 and len(filled) == -(-4900 // 13)


def test_pack_odd_rows(odd, odd_rows, nothing, tokenizer):
    assert packing.pack(packing.token_pieces(odd).select("doc_id", "piece", "length"), cell_rows=2).count() == packing.token_pieces(odd).count()
    brute.packed_right(packing.pack_documents(odd).collect(), [(i, _ids(tokenizer, t)) for i, t in odd_rows])
    assert packing.pack_documents(nothing).count() == 0


# media


def test_png_round_trip_and_damage():
    for data in (b"", b"x", b"y" * 64, bytes(range(256)) * 5):
        payload = media.pad_payload(data)
        assert len(payload) % 64 == 0 and payload[: len(data)] == data
        image = media.png_encode(payload)
        assert media.png_decode(image).tobytes() == payload
        for k in (20, len(image) // 2, len(image) - 14):
            with pytest.raises(ValueError):
                media.png_decode(image[:k] + bytes([image[k] ^ 1]) + image[k + 1 :])
    with pytest.raises(ValueError):
        media.png_decode(b"no image")


def test_malformed_images():
    """Whatever doesn't fit is a ValueError, never another error."""
    header = lambda body: media._chunk(b"IHDR", body)
    good, end = struct.pack(">IIBBBBB", 2, 1, 8, 0, 0, 0, 0), media._chunk(b"IEND", b"")
    data = media._chunk(b"IDAT", zlib.compress(b"\0ab"))
    assert media.png_decode(media.SIGNATURE + header(good) + media._chunk(b"tEXt", b"x") + data + end).tolist() == [[97, 98]]
    for parts in (
        [header(b"abc"), data, end],
        [header(struct.pack(">IIBBBBB", 2, 0, 8, 0, 0, 0, 0)), media._chunk(b"IDAT", zlib.compress(b"")), end],
        [header(struct.pack(">IIBBBBB", 0, 1, 8, 0, 0, 0, 0)), media._chunk(b"IDAT", zlib.compress(b"\0")), end],
        [header(struct.pack(">IIBBBBB", 2, 1, 16, 0, 0, 0, 0)), data, end],
        [data, header(good), end],
        [header(good), header(good), data, end],
        [header(good), data],
        [header(good), end],
        [header(good), data, end, b"more"],
        [header(good), data, media._chunk(b"tEXt", b"x"), data, end],
        [header(good), media._chunk(b"PLTE", b"xyz"), data, end],
        [header(good), media._chunk(b"IDAT", zlib.compress(b"\0abc")), end],
        [header(good), media._chunk(b"IDAT", zlib.compress(b"\0a")), end],
        [header(good), media._chunk(b"IDAT", zlib.compress(b"\7ab")), end],
        [header(good), media._chunk(b"IDAT", b"nothing"), end],
    ):
        with pytest.raises(ValueError):
            media.png_decode(media.SIGNATURE + b"".join(parts))


def test_cosine_hash_by_its_definition():
    """Every coefficient summed sample by sample; heights beyond those whose tables are kept too."""
    r = np.random.default_rng(4)
    for height in (1, 5, 64, media.SMALL + 3):
        image = r.integers(0, 256, (height, 64)).astype(np.uint8)
        low = []
        for u in range(8):
            for v in range(8):
                a = np.cos(np.pi * u * (2 * np.arange(height) + 1) / (2 * height)) * np.sqrt(2 / height)
                b = np.cos(np.pi * v * (2 * np.arange(64) + 1) / 128) * np.sqrt(2 / 64)
                low.append(round(float((image * np.outer(a, b)).sum()), 6) + 0.0)
        low = low[1:]
        middle = sorted(low)[31]
        assert media.cosine_hash(image) == f"{int(''.join('01'[x > middle] for x in low), 2):016x}"


def test_all_filters_are_undone():
    r = np.random.default_rng(0)
    rows = r.integers(0, 256, (40, 64)).astype(np.uint8)
    lines, above = [], np.zeros(64, int)
    for k, row in enumerate(rows.astype(int)):
        kind, left = k * 7 % 5, np.concatenate(([0], row[:-1]))
        corner = np.concatenate(([0], above[:-1]))
        guess = left + above - corner
        near = np.where((abs(guess - left) <= abs(guess - above)) & (abs(guess - left) <= abs(guess - corner)), left, np.where(abs(guess - above) <= abs(guess - corner), above, corner))
        base = [0 * row, left, above, (left + above) // 2, near][kind]
        lines.append(np.concatenate(([kind], (row - base) % 256)))
        above = row
    body = zlib.compress(np.array(lines, np.uint8).tobytes())
    image = media.SIGNATURE + media._chunk(b"IHDR", struct.pack(">IIBBBBB", 64, 40, 8, 0, 0, 0, 0)) + media._chunk(b"IDAT", body[:50]) + media._chunk(b"IDAT", body[50:]) + media._chunk(b"IEND", b"")
    assert (media.png_decode(image) == rows).all()


def test_media_odd_rows(odd, odd_rows, nothing):
    rows = media.read_media(media.encode_media(odd)).collect()
    assert sorted((bytes(r.payload) for r in rows)) == sorted(media.pad_payload((t or "").encode()) for _, t in odd_rows)
    assert media.read_media(media.encode_media(nothing)).count() == 0


def test_media_query(spark, sf_dir, documents_here):
    texts = dict(documents_here)
    for r in media.op9_media(spark, sf_dir).collect():
        payload = media.pad_payload((texts[r.doc_id] or "").encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((texts[r.doc_id] or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        stored = media.png_encode(payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.feature == media.cosine_hash(np.frombuffer(payload, np.uint8).reshape(-1, 64))


# tokens


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_ids(reference, documents_here):
    ranks, wanted = reference
    own = bpe.TextEncoder(ranks, public_tokenizers.PATTERN)
    r = random.Random(0)
    letters = "ab é\n\t  .,'sß日本 \x1c3٤３xyz'll DON'T"
    texts = [t or "" for _, t in documents_here] + ["".join(r.choice(letters) for _ in range(r.randrange(30))) for _ in range(5000)]
    for text in texts:
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == wanted.encode_ordinary(text), repr(text)
        assert own.encoder.decode(ids) == text.encode()


def test_appends_and_edits(reference):
    encoder = bpe.PrefixEncoder(reference[0])
    r = random.Random(1)
    for _ in range(150):
        data = bytes(r.choice(b"abcthe inon") for _ in range(90))
        piece = bpe.EditablePiece(encoder, data[:40])
        piece.append(data[40:])
        assert piece.tokens() == encoder.encode_piece(data)
        a = r.randrange(90)
        b, new = min(90, a + r.randrange(5)), bytes(r.choice(b"abthe") for _ in range(r.randrange(4)))
        piece.replace(a, b, new)
        assert piece.tokens() == encoder.encode_piece(data[:a] + new + data[b:])
    far = bpe.EditablePiece(encoder, b"the onion " * 60)
    far.replace(5, 6, b"x")
    assert far.recomputed < 200 and far.tokens() == encoder.encode_piece(bytes(far.data))


def test_bpe_query(spark, sf_dir, documents_here, reference):
    texts = dict(documents_here)
    for r in bpe.op10_bpe(spark, sf_dir).collect():
        ids = np.array(reference[1].encode_ordinary(texts[r.doc_id] or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest())


def test_bpe_odd_rows(odd, odd_rows, nothing):
    from pyspark.sql import functions as F

    coded = bpe.decode_ids(bpe.encode_texts(odd))
    assert sorted(bytes(r.decoded) for r in coded.collect()) == sorted((t or "").encode() for _, t in odd_rows)
    listed = coded.select("ids", bpe.unpack_ids(F.col("ids")).alias("list")).limit(20).collect()
    assert all(np.frombuffer(bytes(r["ids"]), "<u4").tolist() == r["list"] for r in listed)
    assert bpe.decode_ids(bpe.encode_texts(nothing)).count() == 0

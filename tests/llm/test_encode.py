"""BPE, token counts and WebP."""

import hashlib
import os
import random
import zlib

import numpy as np
import pytest
import tiktoken

from quire.llm import bpe, tokencount, webp


@pytest.fixture(scope="module")
def library():
    path, pattern = bpe.rank_file()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load(path, pattern).ranks, special_tokens={})


def test_bpe_equals_the_library(library):
    coder, rng = bpe.load(*bpe.rank_file()), random.Random(1)
    texts = ["".join(rng.choice("aab éñ漢  \n\t.1'sß😀　") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n a", "a" * 5000, "ab" * 5000, "<|endoftext|>"]
    for text, ids in zip(texts, coder.encode_all(texts), strict=True):
        assert ids == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
    assert coder.queue.top == 0


def test_bpe_rows(spark, odd, none, library):
    rows = bpe.encode(odd).collect()
    assert len(rows) == odd.count() and bpe.encode(none).count() == 0
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[3].n_tokens == by_id[5].n_tokens == 0 and by_id[3].ids_sha256 == hashlib.sha256(b"").hexdigest()
    text = "word"
    assert by_id[10].ids_sha256 == hashlib.sha256(" ".join(map(str, library.encode_ordinary(text))).encode()).hexdigest()
    assert {r.content for r in bpe.decode(bpe.encode(odd)).where("doc_id = 10").collect()} == {b"word"}


def test_token_counts(spark, odd, none, data, library):
    for r in tokencount.op10_tokencount(spark, data).collect():
        assert sum(r.section_tokens) == r.n_tokens and len(r.section_tokens) == r.n_sections
    by_id = {r.doc_id: r for r in tokencount.section_counts(odd).collect()}
    assert by_id[3].n_tokens == 0 and by_id[3].section_tokens == [] and by_id[8].n_tokens > 1000
    assert tokencount.section_counts(none).count() == 0
    texts = spark.read.parquet(f"{data}/documents.parquet").limit(20).collect()
    counts = {r.doc_id: r.n_tokens for r in tokencount.op10_tokencount(spark, data).collect()}
    assert all(counts[t.doc_id] == len(library.encode_ordinary(t.text)) for t in texts)


def test_boundary_rules():
    starts, ends, bounds = np.array([0, 2, 5]), np.array([2, 5, 8]), np.array([0, 3, 8])
    assert tokencount.attribute(starts, ends, bounds, "start")[0].tolist() == [2, 1]
    assert tokencount.attribute(starts, ends, bounds, "end")[0].tolist() == [1, 2]
    assert tokencount.attribute(starts, ends, bounds)[0].tolist() == [1, 2]
    assert tokencount.attribute(starts, ends, np.array([0, 4, 8]))[0].tolist() == [2, 1]
    assert tokencount.attribute(np.array([0]), np.array([4]), np.array([0, 2, 4]))[0].tolist() == [1, 0]


def test_field_counts(spark, odd):
    for r in tokencount.field_counts(odd, "doc_id", ["text", "lang", "row"]).collect():
        assert sum(r.field_tokens) == r.n_tokens and len(r.field_tokens) == 3


@pytest.mark.parametrize("payload", [bytes(64), b"ab" * 32, bytes(range(256)), os.urandom(6400), b"abc" * 64, os.urandom(64 * 16400)], ids=len)
def test_webp_round_trip(payload):
    assert webp.decode_payload(webp.encode_payload(payload)) == payload


def test_webp_rows(spark, odd, none):
    rows = webp.read_media(webp.to_media(odd)).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in odd.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            p = webp.padded(texts[r.doc_id])
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(texts[r.doc_id]), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert webp.read_media(webp.to_media(none)).count() == 0
    assert all(r.width == 16 and len(r.rgba) == 4 * r.width * r.height for r in webp.pixels(webp.to_media(odd)).collect())


class Stream(webp.Writer):
    """A hand-made stream: header, then transforms and images in parts."""

    def __init__(self, width, height):
        super().__init__()
        for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)):
            self.put(value, n)

    def one(self, symbol):
        """A code of one symbol, which takes no bits."""
        for value, n in ((1, 1), (0, 1), (1, 1), (symbol, 8)):
            self.put(value, n)

    def two(self, a, b):
        for value, n in ((1, 1), (1, 1), (1, 1), (a, 8), (b, 8)):
            self.put(value, n)

    def flat(self, argb, main=False, cache=0):
        """An image of one colour."""
        self.put(0, 1)
        if main:
            self.put(0, 1)
        for shift in (8, 16, 0, 24):
            self.one(argb >> shift & 255)
        self.one(0)

    def pixels(self):
        return webp.decode(webp.wrap(self.array_bytes()))

    def array_bytes(self):
        return np.packbits(np.concatenate((self.array(), np.zeros(64, np.uint8))), bitorder="little").tobytes()


def test_webp_subtract_green_and_cross_colour():
    s = Stream(3, 2)
    s.put(1, 1), s.put(2, 2)
    s.put(0, 1)
    s.flat(0xFF102030, main=True)
    assert s.pixels().tolist() == [[[0x30, 0x20, 0x50, 0xFF]] * 3] * 2
    s = Stream(2, 1)
    s.put(1, 1), s.put(1, 2), s.put(0, 3)
    s.flat(0xFF000020)  # red gets green * 32 / 32
    s.put(0, 1)
    s.flat(0xFF102030, main=True)
    assert s.pixels().tolist() == [[[0x30, 0x20, 0x30, 0xFF]] * 2]


@pytest.mark.parametrize("mode", range(14))
def test_webp_predictor_against_plain_loop(mode):
    rng = np.random.default_rng(mode)
    width, height = 7, 5
    residual = rng.integers(0, 256, (height, width, 4))
    packed = webp._numbers(residual.reshape(-1, 4))
    got = webp._channels(webp.undo_predictor(packed.copy(), width, np.full(4, mode << 8), 2)).reshape(height, width, 4)
    want = np.zeros((height, width, 4), int)
    for y in range(height):
        for x in range(width):
            if y == 0:
                p = want[0, x - 1] if x else np.array([255, 0, 0, 0])
            elif x == 0:
                p = want[y - 1, 0]
            else:
                tr = want[y - 1, x + 1] if x + 1 < width else want[y, 0]
                p = webp._predict(mode, want[y, x - 1], want[y - 1, x], want[y - 1, x - 1], tr)
            want[y, x] = (residual[y, x] + p) & 255
    assert (got == want).all()


def test_webp_palette():
    s = Stream(10, 1)
    s.put(1, 1), s.put(3, 2), s.put(1, 8)  # two colours, eight pixels a byte
    s.put(0, 1)
    s.two(0x20, 0x30), s.one(0x10), s.one(0), s.one(0), s.one(0)
    s.put(0, 1), s.put(1, 1)  # colours: green 0x20, then 0x20 + 0x30
    s.put(0, 1)
    s.put(0, 1), s.put(0, 1)
    s.two(0b10101010, 0b01), s.one(0), s.one(0), s.one(0), s.one(0)
    s.put(1, 1), s.put(0, 1)  # the larger symbol has code 1
    assert [p[1] for p in s.pixels()[0].tolist()] == [0x20, 0x50] * 4 + [0x50, 0x20]


def test_webp_back_reference_and_cache():
    s = Stream(6, 1)
    s.put(0, 1)
    s.put(1, 1), s.put(1, 4)  # a cache of two colours
    s.put(0, 1)
    lengths = {7: 2, 9: 2, 256 + 2: 2, 256 + 24 + 1: 2}  # two literals, a copy of three, a cached colour
    s.put(0, 1), s.put(15, 4)
    for n in webp.LENGTH_ORDER:
        s.put({0: 1, 2: 1}.get(n, 0), 3)
    s.put(0, 1)
    for symbol in range(256 + 24 + 2):
        s.put(symbol in lengths, 1)
    for _ in range(3):
        s.one(0)
    s.one(1)  # distance code 1 + 1: the pixel before
    green = {symbol: f"{i:02b}" for i, symbol in enumerate(sorted(lengths))}

    def put(symbol):
        for bit in green[symbol]:
            s.put(int(bit), 1)

    slot = [(0x1E35A7BD * (g << 8) & 0xFFFFFFFF) >> 31 for g in (7, 9)]
    put(7), put(9), put(258)
    put(281)
    last = 9 if slot[1] == 1 else 7 if slot[0] == 1 else 0
    assert [p[1] for p in s.pixels()[0].tolist()] == [7, 9, 9, 9, 9, last]


def test_webp_damage():
    good = webp.encode_payload(os.urandom(640))
    for bad in (b"", good[:30], b"RIFF" + good[4:8] + b"XXXX", webp.wrap(b"\x00" * 20)):
        with pytest.raises((ValueError, IndexError)):
            webp.decode(bad)
    with pytest.raises(ValueError):
        webp.encode_payload(b"x")

"""Lossless WebP media columns: a full decoder, and an encoder for byte payloads.

``decode`` reads any lossless stream: prefix codes (simple and normal, with groups by block), back-references, colour cache, and
the predictor, cross-colour, subtract-green and palette transforms, and gives pixels as an array of R, G, B, A bytes. What a token
at any bit would be is looked up for all bits at once; then the chain of tokens is followed from the first (``read_tokens``).

``encode_payload`` packs bytes four to a pixel, 16 pixels a row. It chooses by content: pixels as they are, a palette, differences
to the left or cross-colour, whichever takes the fewest bits; copies of earlier pixels; a colour cache where it saves bits; and
a prefix code by the frequencies of each channel. Payloads over 16,384 rows get wider rows and zeros at the end, and their length
is kept in a chunk of its own; more than ``MOST_PAYLOAD`` bytes are stored as several files one after another.

Defined cases: a null text is empty; an empty payload is padded to 64 zero bytes; equal texts give equal bytes; null ids, repeated
rows and extra columns change nothing; an empty table gives an empty result. A damaged stream raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, slices

ROW_BYTES = 64
MAX_SIDE = 1 << 14
MOST_PAYLOAD = 1 << 28
#: Pixels of a copy, and how far away it may be; with more copies the encoder uses no colour cache; bits of a code.
LEAST_COPY, MOST_COPY, MOST_DISTANCE, MOST_SEGMENTS, MOST_BITS = 4, 4096, (1 << 20) - 120, 8, 12
# Fixed values of the format: order in which the lengths of the code-length code are stored, and the short distances as (x, y).
LENGTH_ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
SHORT_DISTANCES = [
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2),
    (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0),
    (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4),
    (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3),
    (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4),
    (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7),
    (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
]
N_LENGTHS, HASH = 24, 0x1E35A7BD
N_DISTANCES = 40
#: Bits that are scanned at once, and the most that one pixel or back-reference takes.
SCAN, TOKEN_BITS = 1 << 16, 64
#: Bytes of payloads that are written at once.
BATCH = 1 << 18


class Bits:
    """Reader of bits, lowest first, through a number that holds the next bytes."""

    def __init__(self, data: bytes):
        self.data, self.at, self.end = data, 0, 8 * len(data)
        self.word, self.base, self.limit = 0, 0, 0

    def peek(self, n: int) -> int:
        """The next n (at most 64) bits; zeros follow the end."""
        if self.at + n > self.limit or self.at < self.base:
            byte = self.at >> 3
            self.base, self.limit = byte << 3, (byte + 128) << 3
            self.word = int.from_bytes(self.data[byte : byte + 128], "little")
        return (self.word >> (self.at - self.base)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        if self.at + n > self.end:
            raise ValueError("the stream ends too early")
        value = self.peek(n)
        self.at += n
        return value


class Prefix:
    """A prefix code: canonical codes by length, as a table over all values of the longest code's bits, first bit highest."""

    def __init__(self, symbols: np.ndarray | list[int], lengths: np.ndarray | list[int]):
        if not len(symbols):
            raise ValueError("a prefix code without symbols")
        key = np.asarray(lengths, np.int64) << 12 | symbols
        key.sort()
        self.single = int(key[0]) & 4095 if len(key) == 1 else None
        self.longest = int(key[-1]) >> 12 if self.single is None else 0
        sizes = key >> 12 if self.single is None else np.zeros(1, np.int64)
        times = np.left_shift(1, self.longest - sizes)
        if int(times.sum()) != 1 << self.longest:
            raise ValueError("a prefix code that isn't complete")
        #: symbol << 4 | bits of its code, by the next bits, the first highest
        self.table = np.repeat((key & 4095) << 4 | sizes, times)
        self.listed: list[int] | None = None

    def read(self, bits: Bits) -> int:
        if self.single is not None:
            return self.single
        if self.listed is None:
            self.lowest_first()
        entry = self.listed[bits.peek(self.longest)]
        bits.at += entry & 15
        if bits.at > bits.end:
            raise ValueError("the stream ends too early")
        return entry >> 4

    def lowest_first(self) -> list[int]:
        """The table by the next bits as they are stored, lowest first."""
        if self.listed is None:
            self.listed = self.table[mirrored(self.longest)].tolist()
        return self.listed


@lru_cache(maxsize=16)
def mirrored(n: int) -> np.ndarray:
    """All numbers of n bits, bits in reverse order."""
    values = np.arange(1 << n)
    out = np.zeros_like(values)
    for i in range(n):
        out |= (values >> i & 1) << (n - 1 - i)
    return out


@lru_cache(maxsize=256)
def _code_of_lengths(stored: int, n: int) -> Prefix:
    lengths = dict(sorted((LENGTH_ORDER[i], stored >> 3 * i & 7) for i in range(n) if stored >> 3 * i & 7))
    return Prefix(list(lengths), list(lengths.values()))


def read_prefix(bits: Bits, alphabet: int) -> Prefix:
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        symbols = {bits.read(8 if wide else 1)} | ({bits.read(8)} if two else set())
        return Prefix(sorted(symbols), [1] * len(symbols))
    n = 4 + bits.read(4)
    code = _code_of_lengths(bits.read(3 * n), n)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    listed, mask = code.lowest_first(), (1 << code.longest) - 1
    lengths = bytearray()
    add = lengths.append
    while left and len(lengths) < alphabet:
        # 72 codes with what follows them, of 14 bits at most, lie in one number
        word, k = int.from_bytes(bits.data[bits.at >> 3 : (bits.at >> 3) + 128], "little") >> (bits.at & 7), 0
        for i in range(min(left, 72)):
            entry = listed[word >> k & mask]
            k += entry & 15
            n = entry >> 4
            if n < 16:
                add(n)
            elif n == 16:
                lengths += (lengths.rstrip(b"\0")[-1:] or b"\x08") * (3 + (word >> k & 3))
                k += 2
            elif n == 17:
                lengths += bytes(3 + (word >> k & 7))
                k += 3
            else:
                lengths += bytes(11 + (word >> k & 127))
                k += 7
            if len(lengths) >= alphabet:
                break
        left -= i + 1
        bits.at += k
        if bits.at > bits.end:
            raise ValueError("the stream ends too early")
    if len(lengths) > alphabet:
        raise ValueError("more code lengths than symbols")
    sizes = np.frombuffer(lengths, np.uint8)
    symbols = np.flatnonzero(sizes)
    return Prefix(symbols, sizes[symbols])


def _extra(symbol):
    """Bits that follow the prefix symbol of a length or distance."""
    return np.maximum(0, (symbol - 2) >> 1)


def _value(bits: Bits, symbol: int) -> int:
    """Length or distance for a prefix symbol."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def _blocks(n: int, size_bits: int) -> int:
    return (n + (1 << size_bits) - 1) >> size_bits


def _distance(code: int, width: int) -> int:
    if code > 120:
        return code - 120
    dx, dy = SHORT_DISTANCES[code - 1]
    return max(1, dx + dy * width)


def _slot(pixels: np.ndarray, cache_bits: int) -> np.ndarray:
    """Places of pixels in the colour cache."""
    return (pixels * HASH & 0xFFFFFFFF) >> (32 - cache_bits)


def read_image(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """Pixels as ARGB numbers; only the main image may have groups of codes."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("colour cache too large")
    groups, size_bits, n_groups = None, 0, 1
    if main and bits.read(1):
        size_bits = bits.read(3) + 2
        groups = (read_image(bits, _blocks(width, size_bits), _blocks(height, size_bits), False) >> 8) & 0xFFFF
        groups = groups.reshape(-1, _blocks(width, size_bits))
        n_groups = int(groups.max()) + 1
    sizes = (256 + N_LENGTHS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, N_DISTANCES)
    codes = [[read_prefix(bits, n) for n in sizes] for _ in range(n_groups)]
    if n_groups == 1:
        return place(*read_tokens(bits, codes[0], width * height), width, width * height, cache_bits)
    return _by_group(bits, codes, groups, size_bits, width, width * height, cache_bits)


def read_tokens(bits: Bits, codes: list[Prefix], total: int):
    """All literals, cached colours and back-references of an image with one group of codes: symbol of green, ARGB number of
    literals, length, distance code.

    A token begins where the one before ends, but what a token at any bit would hold can be looked up for all bits at once; then
    only the chain of ends is followed."""
    green, red, blue, alpha, distance = codes
    if not any(c.longest for c in codes[:4]) and green.single < 256:  # one colour, without any bits
        colour = alpha.single << 24 | red.single << 16 | green.single << 8 | blue.single
        return np.full(total, green.single), np.full(total, colour), np.ones(total, np.int64), np.zeros(total, np.int64)
    if not green.longest and green.single >= 256:
        raise ValueError("an image without a literal")
    data, longest = np.frombuffer(bits.data, np.uint8), max(c.longest for c in codes)
    # tables by the bits of the longest code, narrow where they are looked up for all bits: sizes of red, blue and alpha in one
    wide = [np.repeat(c.table, 1 << longest - c.longest) if c.longest else np.full(1 << longest, c.single << 4) for c in codes]
    firsts = wide[0].astype(np.uint16)
    three_sizes = (wide[1] & 15 | (wide[2] & 15) << 4 | (wide[3] & 15) << 8).astype(np.uint16)
    parts, done, at = [], 0, bits.at
    while done < total:
        if at >= bits.end:
            raise ValueError("the stream ends too early")
        byte, skip = divmod(at, 8)
        # the next bits at each bit, the first highest, from three bytes whose bits are turned round
        part = mirrored(8).take(data[byte : byte + (SCAN + 2 * TOKEN_BITS) // 8])
        n = min(SCAN, 8 * len(part) - skip)
        part = np.concatenate((part, np.zeros(2 * TOKEN_BITS // 8 + 2, np.int64)))
        three = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        window = three[:, None] >> (24 - longest - np.arange(8))
        window &= (1 << longest) - 1
        window = window.ravel()[skip:]
        g = firsts.take(window[:n], mode="clip")
        stop = (g & 15).astype(np.int64)
        stop += np.arange(n)
        ends = stop
        if codes[1].longest or codes[2].longest or codes[3].longest:
            sizes = three_sizes.take(window, mode="clip")
            for c, shift in zip(codes[1:4], (0, 4, 8), strict=True):
                if c.longest:
                    ends = ends + (sizes.take(ends, mode="clip") >> shift & 15).astype(np.int64)
        other = np.flatnonzero(g >= 256 << 4)
        if len(other):
            ends = ends.copy() if ends is stop else ends
            ends[other] = stop[other]
            far = other[g[other] < (256 + N_LENGTHS) << 4]
            if len(far):
                after = stop[far] + _extra((g[far] >> 4).astype(np.int64) - 256)
                d = wide[4].take(window.take(after))
                ends[far] = after + (d & 15) + _extra(d >> 4)
        follow, p, chain = memoryview(ends), 0, array("q")
        add = chain.append
        while p < n:
            add(p)
            p = follow[p]
        chain = np.frombuffer(chain, np.int64)
        s = (g[chain] >> 4).astype(np.int64)
        colour, length, code = np.zeros(len(s), np.int64), np.ones(len(s), np.int64), np.zeros(len(s), np.int64)
        literal = np.flatnonzero(s < 256)
        where = stop[chain[literal]]
        value = s[literal] << 8
        for k, shift in ((1, 16), (2, 0), (3, 24)):
            e = wide[k].take(window.take(where))
            value |= e >> 4 << shift
            where = where + (e & 15)
        colour[literal] = value
        for i in np.flatnonzero((s >= 256) & (s < 256 + N_LENGTHS)).tolist():
            if at + int(ends[chain[i]]) > bits.end:
                break  # behind the last token
            bits.at = at + int(stop[chain[i]])
            length[i] = _value(bits, int(s[i]) - 256)
            code[i] = _value(bits, distance.read(bits))
        made = np.cumsum(length)
        last = int(np.searchsorted(made, total - done))
        if last < len(s):  # the last token
            if made[last] != total - done:
                raise ValueError("a back-reference out of the image")
            s, colour, length, code = (x[: last + 1] for x in (s, colour, length, code))
            p, made = int(ends[chain[last]]), made[: last + 1]
        done += int(made[-1])
        at += p
        if at > bits.end:
            raise ValueError("the stream ends too early")
        parts.append((s, colour, length, code))
    bits.at = at
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def place(symbol, colour, length, code, width, total, cache_bits) -> np.ndarray:
    """The pixels of an image's tokens."""
    cached = symbol >= 256 + N_LENGTHS
    copies = np.flatnonzero((symbol >= 256) & ~cached).tolist()
    if copies:
        first = np.cumsum(length) - length
        out = np.zeros(total, np.int64)
        out[first[symbol < 256]] = colour[symbol < 256]
    else:
        first, out = np.arange(total), colour
    cache = np.zeros(1 << cache_bits, np.int64) if cached.any() else None
    begin = 0  # the first pixel that the cache doesn't hold yet

    def settle(lo, hi):
        """Colours of the cached pixels among tokens lo to hi, none of which is a back-reference."""
        nonlocal begin
        if cache is None or lo == hi:
            return
        here, at = cached[lo:hi], first[lo:hi]
        if at[0] > begin:
            cache[_slot(out[begin : at[0]], cache_bits)] = out[begin : at[0]]
        key = np.where(here, symbol[lo:hi] - 256 - N_LENGTHS, _slot(out[at], cache_bits))
        order = np.argsort(key.astype(np.uint16), kind="stable")
        sorted_key, place_in = key[order], np.arange(len(order))
        source = np.maximum.accumulate(np.where(here[order], -1, place_in))
        place_in[1:][sorted_key[1:] == sorted_key[:-1]] = 0
        inside = source >= np.maximum.accumulate(place_in)  # else the cache has it from before
        value = np.where(inside, out[at[order[source]]], cache[sorted_key])
        out[at[order]] = value
        cache[key] = out[at]
        begin = int(at[-1]) + 1

    last = 0
    for i in copies:
        settle(last, i)
        last = i + 1
        d, at, n = _distance(int(code[i]), width), int(first[i]), int(length[i])
        if d > at:
            raise ValueError("a back-reference out of the image")
        out[at : at + n] = out[at - d : at - d + n] if d >= n else np.resize(out[at - d : at], n)
    settle(last, len(symbol))
    return out


def _by_group(bits, codes, groups, size_bits, width, total, cache_bits) -> np.ndarray:
    """An image whose blocks have different codes: a token's codes hang on its place, so tokens are read one by one."""
    out, cache = np.zeros(total, np.int64), [0] * (1 << cache_bits)
    at, held = 0, 0
    while at < total:
        y, x = divmod(at, width)
        green, red, blue, alpha, distance = codes[int(groups[y >> size_bits, x >> size_bits])]
        s = green.read(bits)
        if s < 256:
            r, b, a = red.read(bits), blue.read(bits), alpha.read(bits)
            out[at] = a << 24 | r << 16 | s << 8 | b
            at += 1
        elif s < 256 + N_LENGTHS:
            length = _value(bits, s - 256)
            d = _distance(_value(bits, distance.read(bits)), width)
            if d > at or at + length > total:
                raise ValueError("a back-reference out of the image")
            out[at : at + length] = np.resize(out[at - d : at], length)
            at += length
        else:
            for v in out[held:at].tolist():  # the cache holds every pixel before this one
                cache[(HASH * v & 0xFFFFFFFF) >> (32 - cache_bits)] = v
            held = at
            out[at] = cache[s - 256 - N_LENGTHS]
            at += 1
    return out


def _channels(pixels: np.ndarray) -> np.ndarray:
    """A, R, G, B in the last axis."""
    return np.stack([(pixels >> s) & 255 for s in (24, 16, 8, 0)], -1)


def _predict(mode: int, l, t, tl, tr):  # noqa: E741
    """Predicted A, R, G, B of one pixel."""
    avg = lambda a, b: (a + b) // 2
    if mode in (1, 2, 3, 4):
        return (l, t, tr, tl)[mode - 1]
    if mode == 5:
        return avg(avg(l, tr), t)
    if mode == 6:
        return avg(l, tl)
    if mode == 7:
        return avg(l, t)
    if mode == 8:
        return avg(tl, t)
    if mode == 9:
        return avg(t, tr)
    if mode == 10:
        return avg(avg(l, tl), avg(t, tr))
    if mode == 11:
        guess = l + t - tl
        return l if np.abs(guess - l).sum() < np.abs(guess - t).sum() else t
    if mode == 12:
        return np.clip(l + t - tl, 0, 255)
    if mode == 13:
        a = avg(l, t)
        return np.clip(a + np.trunc((a - tl) / 2).astype(np.int64), 0, 255)
    return np.array([255, 0, 0, 0])


def undo_predictor(pixels: np.ndarray, width: int, modes: np.ndarray, size_bits: int) -> np.ndarray:
    p = _channels(pixels).reshape(-1, width, 4)
    height = len(p)
    p[0, 0] = (p[0, 0] + (255, 0, 0, 0)) & 255
    p[:, 0] = np.cumsum(p[:, 0], axis=0) & 255
    modes = (modes >> 8 & 15).reshape(-1, _blocks(width, size_bits))
    if (modes == 1).all():
        return _numbers(np.cumsum(p, axis=1) & 255)
    p[0] = np.cumsum(p[0], axis=0) & 255
    for y in range(1, height):
        row, above = p[y], p[y - 1]
        kinds = np.repeat(modes[y >> size_bits], 1 << size_bits)[:width]
        flat = {0: np.array([255, 0, 0, 0])}
        if set(kinds[1:].tolist()) <= {0, 2, 3, 4, 8, 9}:  # no use of the left neighbour: the row at once
            right = np.concatenate((above[1:], row[:1]))
            flat |= {2: above, 3: right, 8: (np.roll(above, 1, 0) + above) // 2, 4: np.roll(above, 1, 0), 9: (above + right) // 2}
            for k in set(kinds[1:].tolist()):
                at = np.flatnonzero(kinds == k)
                at = at[at > 0]
                row[at] = (row[at] + (flat[k] if k == 0 else flat[k][at])) & 255
            continue
        for x in range(1, width):
            tr = above[x + 1] if x + 1 < width else row[0]
            row[x] = (row[x] + _predict(int(kinds[x]), row[x - 1], above[x], above[x - 1], tr)) & 255
    return _numbers(p)


def _numbers(p: np.ndarray) -> np.ndarray:
    p = p.reshape(-1, 4)
    return p[:, 0] << 24 | p[:, 1] << 16 | p[:, 2] << 8 | p[:, 3]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.where(x > 127, x - 256, x)


def undo_cross_colour(pixels: np.ndarray, width: int, elements: np.ndarray, size_bits: int) -> np.ndarray:
    p = _channels(pixels).reshape(-1, width, 4)
    e = _signed(_channels(elements).reshape(-1, _blocks(width, size_bits), 4))
    e = e.repeat(1 << size_bits, 0)[: len(p)].repeat(1 << size_bits, 1)[:, :width]
    green = _signed(p[..., 2])
    p[..., 1] = (p[..., 1] + (e[..., 3] * green >> 5)) & 255
    p[..., 3] = (p[..., 3] + (e[..., 2] * green >> 5) + (e[..., 1] * _signed(p[..., 1]) >> 5)) & 255
    return _numbers(p)


def undo_subtract_green(pixels: np.ndarray) -> np.ndarray:
    p = _channels(pixels)
    p[:, 1] = (p[:, 1] + p[:, 2]) & 255
    p[:, 3] = (p[:, 3] + p[:, 2]) & 255
    return _numbers(p)


def undo_palette(pixels: np.ndarray, packed_width: int, width: int, colours: np.ndarray, bits_each: int) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[: len(colours)] = _numbers(np.cumsum(_channels(colours), axis=0) & 255)
    green = (pixels >> 8 & 255).reshape(-1, packed_width)
    if bits_each < 8:
        per = 8 // bits_each
        green = np.stack([green >> (bits_each * i) & ((1 << bits_each) - 1) for i in range(per)], -1).reshape(len(green), -1)[:, :width]
    return table[green].ravel()


def turned(p: np.ndarray) -> np.ndarray:
    """ARGB numbers to the numbers that R, G, B, A bytes are, or back."""
    return (p & 0xFF00FF00) | (p & 255) << 16 | (p >> 16 & 255)


def decode_stream(data: bytes) -> np.ndarray:
    """A VP8L stream to an array (height, width, 4) of R, G, B, A."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless stream")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, now, seen = [], width, set()
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise ValueError("a transform occurs twice")
        seen.add(kind)
        if kind in (0, 1):
            size_bits = bits.read(3) + 2
            image = read_image(bits, _blocks(now, size_bits), _blocks(height, size_bits), False)
            undo.append(lambda p, w=now, i=image, s=size_bits, f=(undo_predictor, undo_cross_colour)[kind]: f(p, w, i, s))
        elif kind == 2:
            undo.append(undo_subtract_green)
        else:
            n = bits.read(8) + 1
            colours = read_image(bits, n, 1, False)
            bits_each = 1 if n <= 2 else 2 if n <= 4 else 4 if n <= 16 else 8
            packed = -(-now * bits_each // 8)
            undo.append(lambda p, a=packed, w=now, c=colours, b=bits_each: undo_palette(p, a, w, c, b))
            now = packed
    pixels = read_image(bits, now, height, True)
    for f in reversed(undo):
        pixels = f(pixels)
    return turned(pixels).astype("<u4").view(np.uint8).reshape(height, width, 4)


def chunks(data: bytes) -> dict[bytes, bytes]:
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    found, at = {}, 12
    while at + 8 <= len(data):
        n = struct.unpack("<I", data[at + 4 : at + 8])[0]
        found[data[at : at + 4]] = data[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    return found


def decode(data: bytes) -> np.ndarray:
    """A lossless WebP file to an array (height, width, 4) of R, G, B, A."""
    found = chunks(data)
    if b"VP8L" not in found:
        raise ValueError("no lossless image")
    return decode_stream(found[b"VP8L"])


class Writer:
    """Writer of bits, lowest first."""

    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n

    def array(self) -> np.ndarray:
        """The bits that were put."""
        return np.unpackbits(np.frombuffer(self.value.to_bytes((self.n + 7) // 8, "little"), np.uint8), bitorder="little")[: self.n]


def packed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Values of up to 63 bits each as 64-bit words, lowest bit first."""
    values, ends = values.astype(np.uint64), np.cumsum(sizes)
    at = ends - sizes
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    new = np.ones(len(word), bool)
    new[1:] = word[1:] != word[:-1]
    starts = np.flatnonzero(new)
    words = np.zeros((int(ends[-1]) >> 6) + 2, np.uint64)
    words[word[starts]] = np.bitwise_or.reduceat(values << shift, starts)
    words[word[starts] + 1] |= np.bitwise_or.reduceat((values >> np.uint64(1)) >> (np.uint64(63) - shift), starts)
    return words.astype("<u8", copy=False)


#: The code of lengths has 16 symbols of four bits: lengths up to MOST_BITS and the three runs. Codes, and bits with what follows.
FOUR_BITS = np.array([int(f"{min(s, s - 3 if s > 12 else s):04b}"[::-1], 2) if s <= 12 or s >= 16 else 0 for s in range(19)])
MORE_BITS = np.array([4] * 16 + [6, 7, 11])
CODE_OF_LENGTHS = sum(4 << 3 * i for i, s in enumerate(LENGTH_ORDER) if s <= MOST_BITS or s >= 16)


def code_lengths(counts: np.ndarray, group: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Lengths, ``most`` at most, of complete prefix codes, one for each group of at least two symbols (counts above 0, by group):
    near the logarithm of each symbol's share, the rarest made less rare; what is left over shortens the codes of the commonest
    that it is enough for."""
    total, n = np.add.reduceat(counts, starts), np.diff(np.append(starts, len(counts)))
    least = total / ((1 << most) - n)
    sizes = np.maximum(1, np.ceil(np.log2((total + least * n)[group] / (counts + least[group])) - 1e-9)).astype(np.int64)
    top = np.maximum.reduceat(sizes, starts)
    spares = (np.left_shift(1, top) - np.add.reduceat(np.left_shift(1, top[group] - sizes), starts)).tolist()
    order = np.lexsort((-counts, group)).tolist()
    listed = sizes.tolist()
    for spare, first, k, t in zip(spares, starts.tolist(), n.tolist(), top.tolist(), strict=True):
        while spare:
            for i in order[first : first + k]:
                cost = 1 << (t - listed[i])
                while cost <= spare and listed[i] > 1:
                    listed[i] -= 1
                    spare -= cost
                    cost <<= 1
                if not spare:
                    break
    return np.array(listed)


def prefix_codes(counts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A prefix code for each alphabet, whose counts lie one after another from ``bounds``: code (lowest bit first) << 4 | its bits for
    each symbol; values and bits that store the codes; where those of each alphabet begin."""
    table, k = np.zeros(len(counts), np.int64), len(bounds) - 1
    used = np.flatnonzero(counts)
    first = np.searchsorted(used, bounds)
    n = np.diff(first)
    at = used - np.repeat(bounds[:-1], n)
    last = at.take(np.maximum(first[1:] - 1, 0)) if len(at) else n
    normal = (n > 2) | ((n == 2) & (last > 255))
    # first two values an alphabet: those of a simple code; else the code of lengths, then the number of what follows
    head, head_bits = np.zeros((2, 2, k), np.int64)
    head[0], head_bits[0] = 1 | 1 << 2, 11
    some = np.flatnonzero(~normal & (n > 0))
    head[0, some] |= at[first[some]] << 3
    two = some[n[some] == 2]
    head[0, two] |= 1 << 1 | last[two] << 11
    head_bits[0, two] = 19
    table[used[first[two]]], table[used[first[two] + 1]] = 1, 1 << 4 | 1
    tokens, values, bits = np.zeros(k, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if normal.any():
        kept = np.repeat(normal, n)
        used, at, n = used[kept], at[kept], n[normal]
        group, starts = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
        sizes = code_lengths(counts[used], group, starts, MOST_BITS)
        key = group << 4 | sizes
        order = np.argsort(key.astype(np.uint16) if len(n) <= 1 << 12 else key, kind="stable")
        steps = np.left_shift(1, 15 - sizes[order])
        codes = np.empty(len(at), np.int64)
        codes[order] = mirrored(15)[np.cumsum(steps) - steps & 32767]  # a complete code's steps add up to 32768
        table[used] = codes << 4 | sizes
        gap = at.copy()
        gap[1:] -= at[:-1] + 1
        gap[starts] = at[starts]
        long = gap // 138
        rest = gap - 138 * long
        # before each length its zeros: runs of 138, then a run or single ones; none after the last
        many, run = rest > 10, rest > 2
        kinds, more, times = np.full((3, len(at), 3), 18)
        kinds[:, 1], kinds[:, 2] = np.where(many, 18, np.where(run, 17, 0)), sizes
        more[:, 0], more[:, 1], more[:, 2] = 127, np.where(many, rest - 11, np.where(run, rest - 3, 0)), 0
        times[:, 0], times[:, 1], times[:, 2] = long, np.where(run, 1, rest), 1
        tokens[normal] = np.add.reduceat(long + times[:, 1] + 1, starts)
        kinds, times = kinds.ravel(), times.ravel()
        values, bits = np.repeat(FOUR_BITS[kinds] | more.ravel() << 4, times), np.repeat(MORE_BITS[kinds], times)
        rest = tokens[normal] - 2
        wide = np.maximum(0, np.frexp(np.maximum(rest, 1).astype(np.float64))[1] - 1) >> 1
        head[0, normal], head_bits[0, normal] = (19 - 4) << 1 | CODE_OF_LENGTHS << 5, 5 + 3 * 19
        head[1, normal], head_bits[1, normal] = 1 | wide << 1 | rest << 4, 6 + 2 * wide
    begin = np.cumsum(tokens + 2) - tokens - 2
    out, out_bits = np.empty((2, len(values) + 2 * k), np.int64)
    own = np.ones(len(out), bool)
    for i in (0, 1):
        own[begin + i] = False
        out[begin + i], out_bits[begin + i] = head[i], head_bits[i]
    out[own], out_bits[own] = values, bits
    return table, out, out_bits, begin


def _split_value(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix symbol, extra bits and their number of lengths or distance codes."""
    v = n - 1
    top = np.frexp(np.maximum(v, 1).astype(np.float64))[1] - 1
    extra = np.maximum(0, top - 1)
    symbol = np.where(v < 4, v, 2 * top + (v >> np.maximum(top - 1, 0) & 1))
    extra = np.where(v < 4, 0, extra)
    return symbol, v & (np.left_shift(1, extra) - 1), extra


@lru_cache(maxsize=8)
def _short_codes(width: int) -> dict[int, int]:
    """Distance codes of near pixels."""
    return {_distance(code, width): code for code in range(120, 0, -1)}


def repeats(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """Back-references (place, length, distance) of at least LEAST_COPY pixels, from the left, each to the last earlier place that
    begins alike."""
    n = len(pixels)
    if n <= LEAST_COPY:
        return []
    m = n - LEAST_COPY + 1
    key = pixels[:m].copy()
    for k in range(1, LEAST_COPY):
        key = (key ^ key >> 31) * 0x2545F4914F6CDD1D + pixels[k : m + k]
    # the high bits of a hash above the place: sorted, places that begin alike follow each other
    key = ((key ^ key >> 31) * 0x2545F4914F6CDD1D).view(np.uint64)
    low = np.uint64((1 << m.bit_length()) - 1)
    key &= ~low
    key |= np.arange(m, dtype=np.uint64)
    key.sort()
    same = np.flatnonzero((key[1:] ^ key[:-1]) <= low)
    if not len(same):
        return []
    key = (key & low).astype(np.int64)
    at, source = key[same + 1], key[same]
    by_place = np.argsort(at)
    out, free = [], 0
    for i, j in zip(at[by_place].tolist(), source[by_place].tolist(), strict=True):
        if i < free or i - j > MOST_DISTANCE:
            continue
        length, step = 0, 32
        while i + length < n and length < MOST_COPY:
            a = pixels[i + length : i + min(length + step, MOST_COPY)]
            differ = a != pixels[j + length : j + length + len(a)]
            k = int(differ.argmax())
            if differ[k]:
                length += k
                break
            length, step = length + len(a), step * 4
        if length >= LEAST_COPY:
            out.append((i, length, i - j))
            free = i + length
    return out


@lru_cache(maxsize=1)
def _times_log() -> np.ndarray:
    n = np.arange(1 << 14)
    return n * np.log2(np.maximum(n, 1))


def _bits(n: np.ndarray, total: int) -> np.ndarray:
    """Bits that symbols of these counts (in the last axis, ``total`` together) take with a prefix code, and for the code."""
    logs = _times_log().take(n) if total < 1 << 14 else n * np.log2(np.maximum(n, 1))
    return total * np.log2(max(total, 1)) - logs.sum(-1) + 6 * np.count_nonzero(n, axis=-1)


def _channel_bits(channels: np.ndarray) -> np.ndarray:
    """Bits that each row of bytes takes."""
    k, n = channels.shape
    if n > SCAN:
        counts = np.stack([np.bincount(c, minlength=256) for c in channels])
    else:
        counts = np.bincount((channels + (np.arange(k) << 8)[:, None]).ravel(), minlength=k << 8).reshape(k, 256)
    return _bits(counts, n)


def _bytes(pixels: np.ndarray) -> np.ndarray:
    """A, R, G, B of ARGB numbers in the first axis, as bytes."""
    return np.ascontiguousarray(pixels.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8)[:, 3::-1].T)


class Image:
    """The tokens of an image of ARGB numbers, and the bits ``before`` it. Copies and a colour cache are used, in the main image, where
    they save bits."""

    def __init__(self, before: tuple[int, int], pixels: np.ndarray, width: int, main: bool, plain: float | None = None):
        n = len(pixels)
        copies = repeats(pixels) if main else []
        self.symbol, self.lit, self.plain, self.copies = pixels >> 8 & 255, None, pixels, None
        free = np.ones(n, bool)
        for i, length, _ in copies:
            free[i : i + length] = False
        hit, self.cache_bits = None, 0
        if main and n >= 64 and len(copies) <= MOST_SEGMENTS:
            cache_bits = min(10, n.bit_length() - 1)
            slot = _slot(pixels, cache_bits)
            order = np.argsort(slot.astype(np.uint16), kind="stable")
            in_order = pixels[order]
            found = np.zeros(n, bool)
            found[order[1:]] = in_order[1:] == in_order[:-1]
            found &= free
            slots = slot[found]
            if len(slots):
                plain = float(_channel_bits(_bytes(pixels)).sum()) if plain is None else plain
                if len(slots) * (plain / n - 1) > float(_bits(np.bincount(slots), len(slots))):
                    hit, self.cache_bits = found, cache_bits
                    self.symbol[hit] = 256 + N_LENGTHS + slots
        if copies or hit is not None:
            lit = free.copy() if hit is None else free & ~hit
            self.plain = pixels[lit]
            if copies:
                at, sizes, away = (np.array(x) for x in zip(*copies, strict=True))
                short = _short_codes(width)
                away = np.array([short.get(d, d + 120) for d in away.tolist()])
                free[at] = True
                self.symbol, lit = self.symbol[free], lit[free]
                self.copies = np.cumsum(free)[at] - 1, sizes, away
            self.lit = np.flatnonzero(lit)
        value, bits = before
        if self.cache_bits:
            value, bits = value | (1 | self.cache_bits << 1) << bits, bits + 4
        self.before = value, bits + 1 + main


def write_streams(streams: list[list[Image]]) -> list[bytes]:
    """Bits of the images of each stream. The codes and tokens of all are made at once, since each alone is short."""
    images = [i for s in streams for i in s]
    k, n = np.array([len(i.symbol) for i in images]), np.array([len(i.plain) for i in images])
    alphabets = np.array([(256 + N_LENGTHS + (1 << i.cache_bits if i.cache_bits else 0), 256, 256, 256, N_DISTANCES) for i in images])
    bounds = np.concatenate(([0], np.cumsum(alphabets)))
    base = bounds[:-1].reshape(-1, 5)
    first = np.cumsum(k) - k
    symbol = np.concatenate([i.symbol for i in images]) + np.repeat(base[:, 0], k)
    plain = np.concatenate([i.plain for i in images])
    own = np.repeat(base[:, 1], n)
    coded = [symbol, *((plain >> shift & 255) + (own + 256 * c) for c, shift in enumerate((16, 0, 24)))]
    copies = [c for c, i in enumerate(images) if i.copies is not None]
    if copies:
        times = [len(images[c].copies[0]) for c in copies]
        at, sizes, away = (np.concatenate(x) for x in zip(*(images[c].copies for c in copies), strict=True))
        (ls, lx, ln), (ds, dx, dn) = _split_value(sizes), _split_value(away)
        at, ds = at + np.repeat(first[copies], times), ds + np.repeat(base[copies, 4], times)
        symbol[at] = np.repeat(base[copies, 0], times) + 256 + ls
        coded.append(ds)
    table, stored, stored_bits, begin = prefix_codes(sum(np.bincount(c, minlength=int(bounds[-1])) for c in coded), bounds)
    entry = table.take(symbol)
    value, bits = entry >> 4, entry & 15
    lit = np.concatenate([np.arange(a, a + m) if i.lit is None else i.lit + a for i, a, m in zip(images, first.tolist(), k.tolist(), strict=True)])
    own, wide = value.take(lit), bits.take(lit)
    for c in coded[1:4]:
        entry = table.take(c)
        own |= entry >> 4 << wide
        wide += entry & 15
    value[lit], bits[lit] = own, wide
    if copies:
        more, wide, entry = value[at] | lx << bits[at], bits[at] + ln, table[ds]
        more, wide = more | entry >> 4 << wide, wide + (entry & 15)
        value[at], bits[at] = more | dx << wide, wide + dn
    # each stream begins with a new word
    before, before_bits = np.array([i.before for i in images]).T
    code_bits = np.add.reduceat(stored_bits, begin[::5])
    image_bits = before_bits + code_bits + np.add.reduceat(bits, first)
    held = np.array([len(s) for s in streams])
    total = np.add.reduceat(image_bits, np.cumsum(held) - held)
    parts, part_bits, i = [], [], 0
    begin, ends = [*begin[::5].tolist(), len(stored)], [*first.tolist(), len(value)]
    fill = -total & 63
    nothing = np.zeros(1, np.int64)
    for x, s in enumerate(streams):
        for _ in s:
            parts += before[i : i + 1], stored[begin[i] : begin[i + 1]], value[ends[i] : ends[i + 1]]
            part_bits += before_bits[i : i + 1], stored_bits[begin[i] : begin[i + 1]], bits[ends[i] : ends[i + 1]]
            i += 1
        parts.append(nothing)
        part_bits.append(fill[x : x + 1])
    words = memoryview(packed(np.concatenate(parts), np.concatenate(part_bits))).cast("B")
    at = 8 * (np.cumsum(total + fill) - total - fill >> 6)
    return [bytes(words[a : a + n]) for a, n in zip(at.tolist(), (-(-total // 8)).tolist(), strict=True)]


def image_parts(pixels: np.ndarray, width: int) -> list[Image]:
    """The images of a stream of ARGB numbers. Of the pixels as they are, a palette, differences to the left neighbour and red and
    blue without green, that which takes the fewest bits is stored."""
    height, n = len(pixels) // width, len(pixels)
    value, bits = 0x2F | width - 1 << 8 | height - 1 << 22 | 1 << 36, 40
    rows = np.empty((10, n), np.uint8)
    rows[:4] = _bytes(pixels)
    a, r, g, b = rows[:4]
    np.subtract(rows[1:4:2], g, out=rows[4:6])
    # residuals against the pixel to the left, in the first column that above
    left = rows[6:]
    left[:, :1] = rows[:4, :1] - np.array([[255], [0], [0], [0]], np.uint8)
    np.subtract(rows[:4, 1:], rows[:4, :-1], out=left[:, 1:])
    left[:, width::width] = rows[:4, width::width] - rows[:4, :-width:width]
    colours = np.sort(pixels[:1024])
    colours = colours[np.concatenate(([True], colours[1:] != colours[:-1]))]
    if len(colours) <= 256 and n > 1024:
        colours = np.unique(pixels)
    bits_each = 1 if len(colours) <= 2 else 2 if len(colours) <= 4 else 4 if len(colours) <= 16 else 8
    each = _channel_bits(rows)
    plain, green, shifted = (float(each[x].sum()) for x in ([0, 1, 2, 3], [0, 2, 4, 5], [6, 7, 8, 9]))
    options = {"plain": plain, "green": green + 60, "left": shifted + 60}
    if len(colours) <= 256:
        index = np.searchsorted(colours, pixels)
        options["palette"] = (n * bits_each if bits_each < 8 else float(_bits(np.bincount(index), n))) + 26 * len(colours) + 60
    best = min(options, key=options.get)

    images, main_bits = [], options[best] - 60
    blocks = _blocks(width, 9) * _blocks(height, 9)
    if best == "plain":
        main_bits = plain
    elif best == "left":
        images.append(Image((value | (1 | 7 << 3) << bits, bits + 6), np.full(blocks, 1 << 8), 1, False))
        pixels = _numbers(left.T.astype(np.int64))
    elif best == "green":
        # red and blue get 32 / 32 of green
        images.append(Image((value | (1 | 1 << 1 | 7 << 3) << bits, bits + 6), np.full(blocks, 32 << 8 | 32), 1, False))
        pixels = _numbers(rows[[0, 4, 2, 5]].T.astype(np.int64))
    else:
        steps = _channels(colours)
        steps[1:] -= steps[:-1].copy()
        images.append(Image((value | (1 | 3 << 1 | len(colours) - 1 << 3) << bits, bits + 11), _numbers(steps & 255), len(colours), False))
        per = 8 // bits_each
        packed_width = -(-width // per)
        index = np.pad(index.reshape(height, width), ((0, 0), (0, packed_width * per - width))).reshape(height, packed_width, per)
        pixels = ((index << (np.arange(per) * bits_each)).sum(-1) << 8).ravel() | 255 << 24
        width, main_bits = packed_width, None
    images.append(Image((0, 1) if images else (value, bits + 1), pixels, width, True, main_bits))
    return images


def wrap(stream: bytes, more: bytes = b"") -> bytes:
    body = b"WEBPVP8L" + struct.pack("<I", len(stream)) + stream + b"\0" * (len(stream) % 2) + more
    return b"RIFF" + struct.pack("<I", len(body)) + body


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """Each payload of a positive multiple of 64 bytes as a lossless WebP file; more than MOST_PAYLOAD bytes as several, one after
    another. Payloads of up to BATCH bytes together are written at once."""
    if any(not p or len(p) % ROW_BYTES for p in payloads):
        raise ValueError("a payload is a positive multiple of 64 bytes")
    files, streams, extras, held, waiting = [b""] * len(payloads), [], [], [], 0

    def write():
        for i, stream, more in zip(held, write_streams(streams), extras, strict=True):
            files[i] += wrap(stream, more)
        for x in (held, streams, extras):
            x.clear()

    for i, whole in enumerate(payloads):
        for at in range(0, len(whole), MOST_PAYLOAD):
            payload, more = whole[at : at + MOST_PAYLOAD], b""
            if held and waiting + len(payload) > BATCH:
                write()
                waiting = 0
            waiting += len(payload)
            rows = len(payload) // ROW_BYTES
            factor = -(-rows // MAX_SIDE)
            width, height = 16 * factor, -(-rows // factor)
            if 4 * width * height != len(payload):
                more = b"SIZE" + struct.pack("<IQ", 8, len(payload))
                payload = payload.ljust(4 * width * height, b"\0")
            held.append(i)
            extras.append(more)
            streams.append(image_parts(turned(np.frombuffer(payload, "<u4").astype(np.int64)), width))
    if held:
        write()
    return files


def encode_payload(payload: bytes) -> bytes:
    return encode_payloads([payload])[0]


def decode_payload(data: bytes) -> bytes:
    parts, at = [], 0
    while at < len(data):
        n = 8 + struct.unpack("<I", data[at + 4 : at + 8])[0]
        part = data[at : at + n] if at or n < len(data) else data
        payload = decode(part).tobytes()
        size = chunks(part).get(b"SIZE")
        parts.append(payload if size is None else payload[: struct.unpack("<Q", size)[0]])
        at += n
    return parts[0] if len(parts) == 1 else b"".join(parts)


def padded(content: bytes) -> bytes:
    n = max(ROW_BYTES, -(-len(content) // ROW_BYTES) * ROW_BYTES)
    return content.ljust(n, b"\0")


def feature(payload: bytes) -> str:
    """Mean of each byte place in 16 bands of the payload, against the whole mean: 64 bits as hex, then that mean."""
    p = np.frombuffer(payload, np.uint8).reshape(-1, 4).astype(np.int64)
    bands = (np.arange(16) * len(p)) // 16
    sums, sizes = np.add.reduceat(p, bands, axis=0), np.diff(np.append(bands, len(p)))
    high = (sums * p.size > p.sum() * sizes[:, None]).ravel()
    return f"{int(''.join('1' if b else '0' for b in high), 2):016x}-{int(p.sum() // p.size):03d}"


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes of the text and media, the WebP file of its padded bytes."""

    def rows(batches):
        for batch in slices(batches):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            yield [batch.column(0), [len(t) for t in texts], encode_payloads([padded(t) for t in texts])]

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id long, n_bytes long, media binary", rows)


def read_media(media: DataFrame) -> DataFrame:
    """Payload digests and a feature of each stored file; a null file has none."""

    def rows(batches):
        for batch in slices(batches):
            out = []
            for data in batch.column(2).to_pylist():
                if data is None:
                    out.append((None,) * 6)
                    continue
                payload = decode_payload(data)
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW_BYTES:]), len(data), hashlib.sha256(data).hexdigest(), feature(payload)))
            yield [batch.column(0), batch.column(1), *map(list, zip(*out, strict=True))]

    return arrow_map(media, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", rows)


def pixels(media: DataFrame) -> DataFrame:
    """Pixel arrays of any lossless files in a column ``media``: doc_id, width, height, rgba (binary, four bytes a pixel)."""

    def rows(batches):
        for batch in slices(batches, 1 << 20):
            found = [None if d is None else decode(d) for d in batch.column(1).to_pylist()]
            yield [batch.column(0), [None if p is None else p.shape[1] for p in found], [None if p is None else p.shape[0] for p in found], [None if p is None else p.tobytes() for p in found]]

    return arrow_map(media.select(F.col("doc_id").cast("long"), "media"), "doc_id long, width int, height int, rgba binary", rows)


def op7_webp(spark, sf_dir: str) -> DataFrame:
    """Every text stored as lossless WebP, read back and described."""
    return read_media(to_media(spark.read.parquet(f"{sf_dir}/documents.parquet")))

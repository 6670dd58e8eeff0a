"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each pre-token (a match of the split pattern) is merged on its own. Its adjacent pairs wait in one bucket per merge rank; a
three-level bitmap over the ranks gives the lowest non-empty bucket by find-first-set, so a merge costs a few word operations
however long the pre-token is. Buckets hold linked-list positions and are sorted once, when their turn comes. Entries are never
removed when a merge makes them invalid: an entry counts only while its position still starts a pair of that rank.

Texts are cut to chunks that no match of the pattern crosses. A chunk is encoded, and its ids decoded, once as long as a worker
remembers it; a text's ids and decoded bytes are those of its chunks one after another.

Defined cases: a null text is empty; an empty text has no tokens and the digests of the empty string; null ids, repeated rows
and extra columns change nothing (only ``doc_id`` and ``text`` are read); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, remembers, slices

#: Chunks that a worker remembers before it forgets those not used since; bounds its memory.
CACHE_ENTRIES = 500_000
NAMES, BYTES = itemgetter(0), itemgetter(1)
#: A space that has white space, or an end of the text, on both sides.
SPACE_BETWEEN = re.compile(r"\s \s|\s $|^ \s| $")


class RankQueue:
    """Buckets of positions by rank below a three-level bitmap with 64-bit words."""

    def __init__(self, n_ranks: int):
        words = n_ranks // 64 + 1
        self.low, self.mid, self.top = [0] * words, [0] * (words // 64 + 1), 0
        self.buckets: dict[int, list[int]] = {}

    def fill(self, rank: int, positions: list[int]) -> None:
        """Open a bucket."""
        self.buckets[rank] = positions
        word = rank >> 6
        self.low[word] |= 1 << (rank & 63)
        self.mid[word >> 6] |= 1 << (word & 63)
        self.top |= 1 << (word >> 6)

    def first(self) -> int:
        """The lowest rank that has entries, -1 if none: find-first-set on each level."""
        if not self.top:
            return -1
        a = (self.top & -self.top).bit_length() - 1
        m = self.mid[a]
        b = (a << 6) + (m & -m).bit_length() - 1
        m = self.low[b]
        return (b << 6) + (m & -m).bit_length() - 1

    def take(self, rank: int) -> list[int]:
        """The positions of a bucket, leftmost first; the bucket is forgotten."""
        b = rank >> 6
        self.low[b] &= ~(1 << (rank & 63))
        if not self.low[b]:
            self.mid[b >> 6] &= ~(1 << (b & 63))
            if not self.mid[b >> 6]:
                self.top &= ~(1 << (b >> 6))
        positions = self.buckets.pop(rank)
        positions.sort()
        return positions


class Generations:
    """What a worker remembers: two dictionaries, of which the older goes when the newer is full and what is used stays."""

    def __init__(self, entries: int):
        self.entries, self.now, self.old = entries, {}, {}

    def turn(self) -> None:
        if len(self.now) > self.entries:
            self.now, self.old = {}, self.now

    def unknown(self, keys: set) -> set:
        """The keys that aren't remembered; the others are in ``now`` afterwards."""
        missing = keys.difference(self.now)
        if self.old:
            again = missing.intersection(self.old)
            self.now.update(zip(again, map(self.old.__getitem__, again), strict=True))
            missing -= again
        return missing

    def clear(self) -> None:
        self.now, self.old = {}, {}


def ids_of(chunks: list[tuple[bytes, bytes]]) -> list[int]:
    return [int(x) for names, _ in chunks for x in names.split()]


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        size = max(ranks.values(), default=0) + 1
        self.table, self.names = [b""] * size, [b"%d" % i for i in range(size)]
        for b, i in ranks.items():
            self.table[i] = b
        self.queue = RankQueue(size)
        #: A symbol that stands between pre-tokens and is in no pair.
        self.gap = size
        #: Rank of what two neighbours make together, by left << 20 | right.
        self.joins = {ranks[b[:k]] << 20 | ranks[b[k:]]: i for b, i in ranks.items() for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks}
        self.single = np.array([ranks.get(bytes([b]), size) for b in range(256)] + [size], np.int64)
        self.start = np.full((257, 257), -1, np.int64)
        for b, i in ranks.items():
            if len(b) == 2:
                self.start[b[0], b[1]] = i
        #: What was encoded: the ids as text and the bytes they stand for. By what follows a space in a text, and by pre-tokens
        #: that don't begin with one.
        self.chunks, self.others = Generations(CACHE_ENTRIES), Generations(CACHE_ENTRIES)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Merge many pre-tokens in one queue: they lie one after another in one linked list, with a gap after each that no pair
        crosses, so each comes out as if alone."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes + 1)
        n = int(ends[-1])
        code = np.full(n, 256, np.int64)
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        code[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        first = np.append(self.start[code[:-1], code[1:]], -1)
        symbol, pair, after, before = self.single[code].tolist(), first.tolist(), list(range(1, n + 1)), list(range(-1, n))
        queue, get, buckets = self.queue, self.joins.get, self.queue.buckets
        at = np.flatnonzero(first >= 0)
        at = at[np.argsort(first[at], kind="stable")]
        edges = np.flatnonzero(np.r_[True, first[at][1:] != first[at][:-1]]) if len(at) else at
        for positions, rank in zip(np.split(at, edges[1:]), first[at][edges].tolist(), strict=False):
            queue.fill(rank, positions.tolist())
        gone = bytearray(n)
        while (rank := queue.first()) >= 0:
            bucket, own, lower = queue.take(rank), rank << 20, False
            for i in bucket:
                if pair[i] != rank:  # stale
                    continue
                middle = after[i]
                gone[middle], pair[middle], symbol[i] = 1, -1, rank
                stop = after[i] = after[middle]
                before[stop] = i
                pair[i] = r = get(own | symbol[stop], -1)
                if r >= 0:
                    if r in buckets:
                        buckets[r].append(i)
                    else:
                        queue.fill(r, [i])
                    lower = r <= rank
                left = before[i]
                if left >= 0:
                    pair[left] = r = get(symbol[left] << 20 | rank, -1)
                    if r >= 0:
                        if r in buckets:
                            buckets[r].append(left)
                        else:
                            queue.fill(r, [left])
                        lower |= r <= rank
                if lower:  # goes before what is left of this bucket
                    rest = bucket[bisect_right(bucket, i) :]
                    if rank in buckets:
                        buckets[rank] += rest
                    elif rest:
                        queue.fill(rank, rest)
                    break
        stays = inside & (np.frombuffer(gone, np.uint8) == 0)
        ids = np.array(symbol)[stays].tolist()
        counts = np.add.reduceat(stays.astype(np.int64), ends - sizes - 1) if n else sizes
        stops = np.cumsum(counts).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *stops], stops, strict=False)]

    def learn(self, pieces: set[str]) -> None:
        """Encode the pre-tokens that aren't remembered, about 32 KB at a time, so that a merge stays in the processor's caches."""
        ranks, part, size = self.ranks, [], 0
        chunks, others = self.chunks.now, self.others.now
        missing = [" " + p for p in self.chunks.unknown({p[1:] for p in pieces if p[0] == " "})]
        missing += self.others.unknown({p for p in pieces if p[0] != " "})

        def done():
            for p, ids in zip([p for p, _ in part], self.merge([r for _, r in part]), strict=True):
                put(p, ids)

        def put(piece, ids):
            found = b" ".join(map(self.names.__getitem__, ids)), self.decode(ids)
            if piece[0] == " ":
                chunks[piece[1:]] = found
            else:
                others[piece] = found

        for piece in missing:
            raw = piece.encode()
            if (whole := ranks.get(raw)) is not None:
                put(piece, (whole,))
            else:
                part.append((piece, raw))
                size += len(raw)
            if size > 1 << 15:
                done()
                part, size = [], 0
        done()

    def joined(self, pieces: list[str]) -> tuple[bytes, bytes]:
        """What is remembered of pre-tokens, put together."""
        chunks, others = self.chunks.now, self.others.now
        names, content = zip(*[chunks[p[1:]] if p[0] == " " else others[p] for p in pieces], strict=True)
        return b" ".join(names), b"".join(content)

    def encode_chunks(self, texts: list[str]) -> Iterator[list[tuple[bytes, bytes]]]:
        """Each text as its chunks: ids as text and decoded bytes.

        A text is cut before each space unless white space stands on both sides of one: no match of the pattern crosses such
        a cut, so what lies between two cuts always has the same matches and is remembered as one chunk."""
        self.chunks.turn()
        self.others.turn()
        cuttable = [not SPACE_BETWEEN.search(text) for text in texts]
        cut = [text.split(" ") if ok else self.split(text) for text, ok in zip(texts, cuttable, strict=True)]
        wanted = set()
        for parts, ok in zip(cut, cuttable, strict=True):
            if ok:
                wanted.update(parts[1:])
        split, pieces = {}, set()
        for chunk in self.chunks.unknown(wanted):
            if chunk.isascii() and chunk.isalpha():  # a pre-token as it stands
                pieces.add(" " + chunk)
            else:
                split[chunk] = found = self.split(" " + chunk)
                pieces.update(found)
        heads = [self.split(parts[0]) if ok else parts for parts, ok in zip(cut, cuttable, strict=True)]
        self.learn(pieces.union(*heads))
        known = self.chunks.now
        for chunk, found in split.items():
            if len(found) > 1:
                known[chunk] = self.joined(found)
        for parts, head, ok in zip(cut, heads, cuttable, strict=True):
            out = [self.joined(head)] if head else []
            if ok:
                out.extend(map(known.__getitem__, parts[1:]))
            yield out

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        return [ids_of(chunks) for chunks in self.encode_chunks(texts)]

    def forget(self) -> None:
        self.chunks.clear()
        self.others.clear()

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker process for a rank file (base64 token and rank a line)."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ByteBpe(ranks, pattern)


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and split pattern of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _encode_rows(batches, name, ids_too, entries=CACHE_ENTRIES):
    coder = load(*rank_file(name))
    coder.chunks.entries = coder.others.entries = entries
    remembers("bpe", coder.forget)
    for batch in slices(batches, 1 << 20):
        ids_out, counts, id_hashes, decoded_hashes = [], [], [], []
        for chunks in coder.encode_chunks([text or "" for text in batch.column(1).to_pylist()]):
            names = b" ".join(map(NAMES, chunks))
            counts.append(names.count(b" ") + 1 if names else 0)
            if ids_too:
                ids_out.append(ids_of(chunks))
            id_hashes.append(hashlib.sha256(names).hexdigest())
            decoded_hashes.append(hashlib.sha256(b"".join(map(BYTES, chunks))).hexdigest())
        yield [batch.column(0), *([ids_out] if ids_too else []), counts, id_hashes, decoded_hashes]


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", keep_ids: bool = True, entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row per document: doc_id, [ids array<int>,] n_tokens, ids_sha256, decoded_sha256; a map without a shuffle. ``entries`` bounds
    what a worker remembers, not what it encodes."""
    schema = "doc_id long, " + ("ids array<int>, " if keep_ids else "") + "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), schema, lambda batches: _encode_rows(batches, vocabulary, keep_ids, entries))


def decode(encoded: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """From doc_id and ids (null: none) back to bytes: doc_id, content binary."""

    def rows(batches):
        coder = load(*rank_file(vocabulary))
        for batch in slices(batches):
            yield [batch.column(0), [coder.decode(ids.as_py() or ()) for ids in batch.column(1)]]

    return arrow_map(encoded.select(F.col("doc_id").cast("long"), "ids"), "doc_id long, content binary", rows)


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole text of documents encoded and decoded; digests of ids and of decoded bytes."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_ids=False)

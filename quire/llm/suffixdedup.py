"""Removal of every byte covered by a repeated string of ``LENGTH`` bytes, by a distributed array of suffixes.

Sorting every suffix of a corpus would move each byte hundreds of times, so suffixes are anchored: a string of ``LENGTH`` bytes is named by
the start of the smallest (hashed, leftmost) of its 16-byte grams, its anchor. Equal strings have equal anchors at equal
offsets, so only suffixes that start at anchors (about one in 190 bytes) are sorted, and each carries the run of strings that it
anchors.

1. Runs of equal content are counted. If a run occurs twice, all its strings do.
2. Different runs of one anchor may still share strings. One copy of each is range-partitioned by sampled splitters over the leading
   tokens (8 bytes) of its suffix; a bucket sorts the strings of its anchors by multikey quicksort over leading token and
   fingerprint, and neighbours are compared.
3. Anchors with more than ``HOT`` different runs have their strings range-partitioned instead, so that no bucket holds a whole
   anchor; the first and last strings of each bucket are compared across the boundaries.
4. The strings found cover intervals of their documents; what is left is hashed.

Bytes themselves are not compared: a match needs an equal 64-bit hash of the anchor and, for whole runs, two more of first and
last string and shape, for single strings the eight bytes at the anchor and a 64-bit hash of the string. Matches never cross
documents; documents of one text are counted as such and worked on once. Long texts are hashed ``SPAN`` bytes at a time, so that
memory doesn't grow with them beyond a few times their own size; a run that a span's end cuts is a run of its own.

``passages`` looks for something else, which says more about short repeats: how many windows of ``PASSAGE`` words (between ASCII
white space) of a document another one has too. Of each window the least ``SEED``-word gram is kept; a repeated window has a gram
that repeats, so only documents with such grams give their windows around them, and a window counts if two texts have it.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes stay whole; copies of a text lose all that is as long as ``LENGTH``;
null ids, repeated rows and extra columns change nothing (rows are told apart by text alone); an empty table gives an
empty result.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, cut, discard, light, slices, stored

LENGTH, GRAM, HOT = 400, 16, 8192
SPAN = 1 << 20
PASSAGE, SEED = 50, 20
#: Most rows of what is found that are broadcast; each is a few dozen bytes.
FOUND_ROWS = 200_000
#: Most texts with copies whose hashes (24 bytes) are broadcast.
COPIED_TEXTS = 1_000_000
_seed = np.random.Generator(np.random.PCG64(3))
_BYTE = _seed.integers(0, 2**64, 256, np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HALF, _32 = np.uint64(29), np.uint64(32)
WHERE = "t0 long, t1 long, a int, b int, o int"


def _join(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of two strings that follow each other, from theirs."""
    h = (x * _A + y) * _B
    return h ^ (h >> _HALF)


def _grams(data: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of the 16-byte strings at each place, and of those of 16, 32, ... 256 bytes."""
    h, size = _BYTE[data], 1
    while size < GRAM:
        h = _join(h[:-size], h[size:])
        size *= 2
    levels = [h]
    while size < 256 and len(h) > size:
        h = _join(h[:-size], h[size:])
        size *= 2
        levels.append(h)
    return levels[0], levels


def fingerprints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams and of the strings of LENGTH (256 + 128 + 16) bytes at each place."""
    grams, levels = _grams(data)
    n = len(data) - LENGTH + 1
    return grams, _join(_join(levels[4][:n], levels[3][256 : 256 + n]), grams[384 : 384 + n])


def anchors(grams: np.ndarray, n: int) -> np.ndarray:
    """For each of n strings the place of its smallest gram, the leftmost on a tie of the upper 32 bits."""
    least = (grams >> _32 << _32) | np.arange(len(grams), dtype=np.uint64)
    width = LENGTH - GRAM + 1
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return (np.minimum(least[:n], least[width - size : width - size + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs_of(content: bytes):
    """First string, last string, anchor, anchor hash and two content hashes of each run."""
    data = np.frombuffer(content, np.uint8)
    grams, prints = fingerprints(data)
    n = len(prints)
    owner = anchors(grams, n)
    a = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    b = np.append(a[1:] - 1, n - 1)
    o = owner[a]
    shape = ((o - a).astype(np.uint64) << _32 | (b - a).astype(np.uint64)) * _A
    return a, b, o, grams[o], prints[a] ^ shape, prints[b] + shape * _B


def multikey_sort(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several key columns: quicksort by the first, and each stretch of equal keys by the next."""
    order = np.argsort(columns[0], kind="quicksort")
    for depth in range(1, len(columns)):
        tied = np.ones(len(order) - 1, bool)
        for c in columns[:depth]:
            tied &= c[order[1:]] == c[order[:-1]]
        edges = np.flatnonzero(np.diff(np.r_[False, tied, False].astype(np.int8)))
        starts, stops = edges[::2], edges[1::2] + 1
        if not len(starts):
            break
        sizes = stops - starts
        inside = np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        stretch = np.repeat(np.arange(len(starts)), sizes)
        order[inside] = order[inside[np.lexsort((columns[depth][order[inside]], stretch))]]
    return order


def _spread(batches):
    for batch in slices(batches, 2 << 20):
        out, whose = [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            content = (text or "").encode()
            for at in range(0, len(content) - LENGTH + 1, SPAN):
                a, b, o, *hashes = runs_of(content[at : at + SPAN + LENGTH - 1])
                out.append((a + at, b + at, o + at, *hashes))
                whose.append(np.full(len(a), i))
        if not out:
            continue
        a, b, o, m, r0, r1 = (np.concatenate(c) for c in zip(*out, strict=True))
        at = np.concatenate(whose)
        t0, t1 = batch.column(0).to_numpy()[at], batch.column(1).to_numpy()[at]
        yield [t0, t1, a.astype(np.int32), b.astype(np.int32), o.astype(np.int32), m.view(np.int64), r0.view(np.int64), r1.view(np.int64)]


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BLANKS = re.compile(rb"[\t-\r ]")
_POWER = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_POWER, SPAN), _powers(_INVERSE, SPAN)


def word_hashes(content: bytes) -> np.ndarray:
    """A hash of each run of bytes between white space, from sums over the bytes so far."""
    out, at = [np.empty(0, np.uint64)], 0
    while at < len(content):
        end = len(content) if len(content) - at <= SPAN // 2 or (gap := _BLANKS.search(content, at + SPAN // 2)) is None else gap.start()
        data = np.frombuffer(content[at:end], np.uint8)
        n = len(data)
        up, down = (_UP, _DOWN) if n <= SPAN else (_powers(_POWER, n), _powers(_INVERSE, n))
        edges = np.flatnonzero(np.diff(_BLANK[data], prepend=True, append=True))
        starts, stops = edges[::2], edges[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:n])))
        h = (sums[stops] - sums[starts]) * down[starts]
        out.append((h ^ (h >> _32)) * _B)
        at = end + 1
    return np.concatenate(out)


def windows_of(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash, and hash of the least gram, of each window of PASSAGE words, some at a time."""
    step = SPAN // 8
    for lo in range(0, len(words) - PASSAGE + 1, step):
        h = [words[lo : lo + step + PASSAGE - 1]]
        for k in range(5):
            h.append(_join(h[-1][: -(1 << k)], h[-1][1 << k :]))
        n = len(h[0]) - PASSAGE + 1
        m = n + PASSAGE - SEED
        grams = _join(h[4][:m], h[2][16 : 16 + m])  # 16 + 4 words
        whole = _join(_join(h[5][:n], h[4][32 : 32 + n]), h[1][48 : 48 + n])  # 32 + 16 + 2
        least = grams
        for k in range(4):
            least = np.minimum(least[: -(1 << k)], least[1 << k :])
        least = np.minimum(least[:n], least[15 : 15 + n])  # the least of 31
        yield whole, least


def _grams_of(batches):
    for batch in slices(batches, 2 << 20):
        keys, grams = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for _, least in windows_of(word_hashes(text.encode())):
                grams.append(np.unique(least))
                keys.append(np.full(len(grams[-1]), key))
        if grams:
            yield [np.concatenate(keys), np.concatenate(grams).view(np.int64)]


def _windows_around(batches):
    for batch in slices(batches, 1 << 20):
        for key, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            wanted = np.array(wanted, np.int64).view(np.uint64)
            for whole, least in windows_of(word_hashes(text.encode())):
                at = np.isin(least, wanted)
                yield [np.full(int(at.sum()), key), whole[at].view(np.int64)]


def passages(keyed: DataFrame, owners: DataFrame) -> DataFrame:
    """t0 and passage_windows of texts that share a window with another text. ``keyed``: t0, t1, text, doc; ``owners``: t0, t1, doc."""
    spark = keyed.sparkSession
    long = keyed.where(F.octet_length("text") >= 2 * PASSAGE - 1)
    grams = stored(arrow_map(long.select("t0", "text"), "t0 long, g long", _grams_of), "grams")
    twice = lambda rows, key: rows.groupBy(key).agg(F.min("t0").alias("lo"), F.max("t0").alias("hi")).where("lo <> hi").select(key)
    wanted = grams.join(light(cut(twice(grams, "g"))), "g").groupBy("t0").agg(F.collect_set("g").alias("wanted"))
    asked = long.join(owners.join(wanted, "t0"), ["t0", "t1", "doc"]).dropDuplicates(["t0", "t1"])
    windows = stored(arrow_map(asked.select("t0", "text", "wanted"), "t0 long, w long", _windows_around), "windows")
    discard(grams)
    found = cut(windows.join(light(cut(twice(windows, "w"))), "w").groupBy("t0").agg(F.count("*").alias("passage_windows")))
    discard(windows)
    settle(spark)
    return found


def _cut_out(batches):
    """The bytes of wanted runs, with the leading token of the suffix at the anchor."""
    for batch in slices(batches, 2 << 20):
        cols = [[] for _ in range(6)]
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            content = (text or "").encode()
            for w in wanted:
                piece = content[w["a"] : w["b"] + LENGTH]
                o = w["o"] - w["a"]
                for c, v in zip(cols, (int.from_bytes(piece[o : o + 8], "big", signed=False) >> 1, w["m"], w["r0"], w["r1"], o, piece), strict=True):
                    c.append(v)
        yield cols


def _strings(pieces: list[bytes]):
    """All strings of LENGTH bytes of the pieces: piece, place in it, leading token, fingerprint."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    starts, counts = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
    _, prints = fingerprints(data)
    piece = np.repeat(np.arange(len(pieces)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[piece] + place
    lead = np.zeros(len(at), np.uint64)
    for i in range(8):
        lead = lead << np.uint64(8) | data[at + i]
    return piece, place, lead, prints[at]


def _intervals(piece: np.ndarray, place: np.ndarray, n: int) -> list[list[int]]:
    """First and last places of the runs of marked strings, flat, for each of n pieces; the input is sorted."""
    out: list[list[int]] = [[] for _ in range(n)]
    if len(piece):
        start = np.r_[True, (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)]
        first, last = np.flatnonzero(start), np.append(np.flatnonzero(start)[1:], len(piece)) - 1
        for p, x, y in zip(piece[first].tolist(), place[first].tolist(), place[last].tolist(), strict=True):
            out[p] += (x, y)
    return out


def _compare(rows):
    """Repeated strings among the runs of each anchor; rows of (m, r0, r1, piece) with whole anchors."""
    ms, pieces = np.array([r[0] for r in rows]), [r[3] for r in rows]
    piece, place, lead, prints = _strings(pieces)
    group = np.unique(ms, return_inverse=True)[1][piece]
    order = multikey_sort([group, lead, prints])
    same = (group[order[1:]] == group[order[:-1]]) & (lead[order[1:]] == lead[order[:-1]]) & (prints[order[1:]] == prints[order[:-1]])
    found = np.zeros(len(piece), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return _intervals(piece[found], place[found], len(pieces))


def _buckets(batches, flush=3 << 19):
    held, size = [], 0

    def out(rows):
        return [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], _compare(rows)]

    for batch in slices(batches):
        for m, r0, r1, piece in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if size > flush and held[-1][0] != m:
                yield out(held)
                held, size = [], 0
            held.append((m, r0, r1, piece))
            size += len(piece)
    if held:
        yield out(held)


def _explode(batches):
    for batch in slices(batches, 1 << 18):
        m, r0, r1 = (batch.column(i).to_numpy() for i in range(3))
        piece, place, lead, prints = _strings(batch.column(3).to_pylist())
        yield [(lead >> np.uint64(1)).astype(np.int64), m[piece], prints.view(np.int64), r0[piece], r1[piece], place.astype(np.int32)]


def _sorted_bucket(batches):
    """Marks rows equal to a neighbour; the first and last keys of the bucket are edges, to be compared across buckets."""
    before = None
    last_row, first = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        lead, m, p, r0, r1, s = (batch.column(i).to_numpy() for i in range(6))
        if before is not None:
            lead, m, p, r0, r1, s = (np.concatenate((x, y)) for x, y in zip(before, (lead, m, p, r0, r1, s), strict=True))
        same = (lead[1:] == lead[:-1]) & (m[1:] == m[:-1]) & (p[1:] == p[:-1])
        mark = np.r_[False, same] | np.r_[same, False]
        if last_row is not None:
            mark[0] |= last_row  # it was equal to the one before it
        edge = np.zeros(len(m), bool)
        edge[0] = first
        first = False
        before, last_row = tuple(x[-1:] for x in (lead, m, p, r0, r1, s)), bool(mark[-1])
        keep = (mark | edge)[:-1]
        yield [x[:-1][keep] for x in (lead, m, p, r0, r1, s, mark, edge)]
    if before is not None:
        yield [*before, np.array([last_row]), np.array([True])]


def _hot(pieces: DataFrame) -> DataFrame:
    """Repeated strings of anchors with very many runs: m, r0, r1, found."""
    rows = stored(arrow_map(pieces.select("m", "r0", "r1", "piece"), "lead long, m long, p long, r0 long, r1 long, s int", _explode), "hot-strings")
    key = ["lead", "m", "p", "r0", "r1", "s"]
    marked = cut(arrow_map(rows.repartitionByRange(*key).sortWithinPartitions(*key), "lead long, m long, p long, r0 long, r1 long, s int, mark boolean, edge boolean", _sorted_bucket))
    discard(rows)
    across = marked.where("edge").groupBy("lead", "m", "p").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    found = marked.where("mark").select("m", "r0", "r1", "s").union(marked.where("edge").join(across, ["lead", "m", "p"]).select("m", "r0", "r1", "s"))
    return found.groupBy("m", "r0", "r1").agg(F.flatten(F.transform(F.array_sort(F.collect_set("s")), lambda s: F.array(s, s))).alias("found"))


def settle(spark) -> None:
    """Let Spark's cleaner remove the shuffle files that no plan refers to any longer."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated(docs: DataFrame) -> DataFrame:
    """t0, t1 (the text's hashes), copies, cover: first and last places of strings that occur elsewhere, flat, and passage_windows."""
    spark = docs.sparkSession
    keyed = docs.select(*text_hashes(), F.col("text").cast("string").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"))
    owners = cut(keyed.groupBy("t0", "t1").agg(F.min("doc").alias("doc"), F.count("*").alias("copies")))
    # of texts with copies, all of which is repeated anyway, one row is worked on
    several = cut(owners.where("copies > 1").select("t0", "t1", F.col("doc").alias("keeps")))
    if several.limit(COPIED_TEXTS + 1).count() <= COPIED_TEXTS:
        once = keyed.join(F.broadcast(several), ["t0", "t1"], "left").where("keeps IS NULL OR keeps = doc").drop("keeps")
    else:
        once = keyed  # copies are only more work; no text is shuffled to leave them out
    shared_windows = passages(once, owners.select("t0", "t1", "doc"))
    runs = stored(arrow_map(once.where(F.octet_length("text") >= LENGTH).select("t0", "t1", "text"), f"{WHERE}, m long, r0 long, r1 long", _spread), "runs")
    # place: a, b - a and o - a in one number, since every byte of these rows is shuffled twice
    place = F.shiftleft(F.col("a").cast("long"), 18) + (F.col("b") - F.col("a")) * 512 + (F.col("o") - F.col("a"))
    unique = runs.select("m", "r0", "r1", "t0", "t1", place.alias("place")).groupBy("m", "r0", "r1").agg(F.count("*").cast("int").alias("n"), *(F.first(c).alias(c) for c in ("t0", "t1", "place")))
    unique = unique.repartition("m")  # each run once, dealt by anchor once for the count and for the join
    per_anchor = unique.groupBy("m").agg(F.count("*").cast("int").alias("variants"), F.sum("n").alias("total")).where("total > 1").drop("total")
    first = F.shiftright("place", 18).cast("int")
    ends = {"a": first, "b": first + F.shiftright("place", 9).bitwiseAND(511).cast("int"), "o": first + F.col("place").bitwiseAND(511).cast("int")}
    shared = stored(unique.join(per_anchor, "m").withColumns(ends).drop("place"), "shared-runs")
    settle(spark)
    again = shared.where("n > 1").select("m", "r0", "r1", F.array(F.lit(0), F.col("b") - F.col("a")).alias("found"))
    asked = shared.where("variants > 1").groupBy("t0", "t1").agg(F.collect_list(F.struct("a", "b", "o", "m", "r0", "r1")).alias("wanted"))
    asked = asked.join(owners.drop("copies"), ["t0", "t1"])
    pieces = arrow_map(keyed.join(asked, ["doc", "t0", "t1"]).select("text", "wanted"), "token long, m long, r0 long, r1 long, o int, piece binary", _cut_out)
    pieces = stored(pieces, "pieces")
    settle(spark)
    hot_anchors = cut(shared.where(F.col("variants") > HOT).select("m").distinct())
    usual = pieces.join(hot_anchors, "m", "left_anti").repartitionByRange("token", "m").sortWithinPartitions("token", "m")
    part = cut(arrow_map(usual.select("m", "r0", "r1", "piece"), "m long, r0 long, r1 long, found array<int>", _buckets).where("size(found) > 0"))
    hot = cut(_hot(pieces.join(hot_anchors, "m", "left_semi").dropDuplicates(["m", "r0", "r1"])))
    discard(pieces)
    settle(spark)
    found = cut(again.union(part).union(hot).groupBy("m", "r0", "r1").agg(F.flatten(F.collect_list("found")).alias("found")))
    places = runs.select("t0", "t1", "a", "m", "r0", "r1").distinct().join(light(found, FOUND_ROWS), ["m", "r0", "r1"])
    cover = places.groupBy("t0", "t1").agg(F.flatten(F.collect_list(F.transform("found", lambda x: x + F.col("a")))).alias("cover"))
    said = owners.join(shared_windows, "t0", "left").where("copies > 1 OR passage_windows IS NOT NULL").drop("doc")
    cover = stored(cover.join(said, ["t0", "t1"], "full_outer"), "cover")
    discard(runs)
    discard(shared)
    settle(spark)
    return cover


def text_hashes():
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.xxhash64(text).alias("t0"), F.xxhash64(F.lit(1), text).alias("t1")


def keep(content: bytes, cover) -> tuple[bytes, int, int]:
    """What is left without the covered bytes, how many went and in how many spans."""
    if not cover:
        return content, 0, 0
    step = np.zeros(len(content) + 1, np.int32)
    pairs = np.array(cover).reshape(-1, 2)
    np.add.at(step, pairs[:, 0], 1)
    np.add.at(step, pairs[:, 1] + LENGTH, -1)
    gone = np.cumsum(step[:-1]) > 0
    return np.frombuffer(content, np.uint8)[~gone].tobytes(), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def dedup(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, passage_windows and, if wanted, kept, the bytes left."""

    def rows(batches):
        for batch in slices(batches):
            out = []
            for text, cover, copies, passage in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                content, again = (text or "").encode(), copies is not None and copies > 1
                left, removed, spans = keep(content, [0, len(content) - LENGTH] if again and len(content) >= LENGTH else cover)
                windows = max(0, len(content.split()) - PASSAGE + 1) if again else passage or 0
                out.append((len(content), removed, spans, hashlib.sha256(left).hexdigest(), windows, *([left] if with_kept else [])))
            yield [batch.column(0), *map(list, zip(*out, strict=True))]

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *text_hashes())
    joined = keyed.join(repeated(docs), ["t0", "t1"], "left").select("doc_id", "text", "cover", "copies", "passage_windows")
    return arrow_map(joined, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, passage_windows long" + (", kept binary" if with_kept else ""), rows)


def op3_suffixdedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 400-byte strings, and how many windows of 50 words of it others have."""
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_kept=False)

"""Whole queries against plain versions of all their columns, and texts of several MB."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_dedup import goals

from quire.llm import bpe, langid, mixing, suffixdedup, tokencount, webp


def trigrams(word):
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(word))]


def test_language_against_plain_version(spark, data):
    """Trigram shares, scripts and Viterbi by plain loops; with so few texts all labelled ones are learned from."""
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    learned = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 != 2 and d.lang is not None and d.text is not None]
    counts, texts = defaultdict(Counter), Counter(d.lang for d in learned)
    assert max(texts.values()) <= langid.DOCS_PER_LANGUAGE
    import regex

    for d in learned:
        for w in regex.findall(r"\p{L}+", d.text.lower()):
            counts[d.lang].update(trigrams(w))
    names = sorted(counts)
    every = set().union(*counts.values())
    floor = langid.SMOOTHING / (len(every) + 1)
    total = {n: sum(counts[n].values()) for n in names}
    usual = min(names, key=lambda n: (-texts[n], n))

    def logs(word):
        return [sum(math.log((1 - langid.SMOOTHING) * counts[n][g] / total[n] + floor) for g in trigrams(word)) for n in names]

    got = {r.doc_id: r for r in langid.op1_langid(spark, data).collect()}
    assert len(got) == len(docs)
    for d in docs:
        words = [w for w in regex.findall(r"\p{L}+", d.text or "")]
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        if not words:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        assert all(langid.script(c) == "latin" for w in words for c in w) and usual in names  # one script, used by all four
        best, back = logs(words[0].lower()), []
        for w in words[1:]:
            top = max(range(len(names)), key=lambda j: (best[j], -j))
            back.append([j if best[j] >= best[top] - langid.SWITCH else top for j in range(len(names))])
            best = [max(best[j], best[top] - langid.SWITCH) + s for j, s in enumerate(logs(w.lower()))]
        label = [max(range(len(names)), key=lambda j: (best[j], -j))]
        for step in reversed(back):
            label.append(step[label[-1]])
        letters = Counter()
        for w, j in zip(words, reversed(label), strict=True):
            letters[j] += len(w)
        first = max(range(len(names)), key=lambda j: (letters[j], -j))
        assert r.lang_pred == names[first] and abs(r.score - letters[first] / sum(letters.values())) < 1e-9


def test_mix_against_plain_version(spark, data):
    """What is taken of each document, from the same hashes by plain loops."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    key = F.xxhash64(F.lit(mixing.SEED), "doc_id", "text")
    rows = docs.select("doc_id", "source", "text", F.pmod(key, F.lit(mixing.BLOCKS)).cast("int").alias("block"), *(mixing._uniform(F.lit(i + 7), key).alias(f"u{i}") for i in range(2))).collect()
    size = {r.doc_id: len([x for x in __import__("re").split(r"[\x20\x09-\x0D]+", r.text or "") if x]) for r in rows}
    words, blocks = Counter(), defaultdict(Counter)
    for r in rows:
        words[r.source] += size[r.doc_id]
        blocks[r.source][r.block] += size[r.doc_id]
    names = sorted(words, key=lambda s: (s is None, s or ""))
    units = [(i, p, b) for i, s in enumerate(names) for b, n in blocks[s].items() if n for p in range(2)]
    hashed = spark.createDataFrame(units, "idx int, pass int, block int").select("*", F.xxhash64(F.lit(mixing.SEED), "idx", "pass", "block").alias("h")).collect()
    target, part = goals(words), {}
    for i, s in enumerate(names):
        done = 0
        for _, _, b, p in sorted((u["pass"], u.h, u.block, u["pass"]) for u in hashed if u.idx == i):
            n = blocks[s][b]
            part[s, b, p] = max(0.0, min(1.0, (round(target[s]) - done) / n))
            done += n
    got = {r.doc_id: r for r in mixing.op2_mixing(spark, data).collect()}
    for r in rows:
        n = size[r.doc_id]
        want = sum(n if part.get((r.source, r.block, p), 0.0) >= 1 else min(n, math.floor(n * part.get((r.source, r.block, p), 0.0) + r[f"u{p}"])) for p in range(2))
        g = got[r.doc_id]
        assert (g["size"], g.source_size, g.taken) == (n, words[r.source], want) and abs(g.target - target[r.source]) < 1e-6


def plain_feature(p):
    pixels = [p[i : i + 4] for i in range(0, len(p), 4)]
    edges = [i * len(pixels) // 16 for i in range(17)]
    whole, bits = sum(p) / len(p), ""
    for a, b in zip(edges, edges[1:], strict=False):
        for c in range(4):
            bits += "1" if sum(x[c] for x in pixels[a:b]) * len(p) > sum(p) * (b - a) else "0"
    return f"{int(bits, 2):016x}-{int(whole):03d}"


def test_media_against_plain_version(spark, data):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = webp.op7_webp(spark, data).collect()
    media = {r.doc_id: bytes(r.media) for r in webp.to_media(spark.read.parquet(f"{data}/documents.parquet")).collect()}
    assert len(got) == len(texts)
    for r in got:
        t, m = texts[r.doc_id], media[r.doc_id]
        p = t + b"\0" * (-len(t) % 64 or (0 if t else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(m), hashlib.sha256(m).hexdigest(), plain_feature(p))


def kinds_used(data):
    """Which parts of the format a stored file uses."""
    seen = set()
    real = webp.place

    def spy(symbol, *rest):
        s = np.asarray(symbol)
        if (s >= 256 + webp.N_LENGTHS).any():
            seen.add("cache")
        if ((s >= 256) & (s < 256 + webp.N_LENGTHS)).any():
            seen.add("copy")
        return real(symbol, *rest)

    originals = {name: getattr(webp, name) for name in ("undo_predictor", "undo_cross_colour", "undo_palette")}

    def noted(name):
        return lambda *a: (seen.add(name), originals[name](*a))[1]

    webp.place = spy
    for name in originals:
        setattr(webp, name, noted(name))
    try:
        webp.decode_payload(data)
    finally:
        webp.place = real
        for name, f in originals.items():
            setattr(webp, name, f)
    return seen


def test_encoder_chooses_by_content():
    rng = np.random.default_rng(3)
    words = b"".join(rng.choice([b"that", b"this", b" and", b" the", b"tion", b"here", b"word"]) + rng.bytes(2) + b"zz" for _ in range(300))
    v = rng.integers(0, 256, 4096)
    grey = np.stack((v, v, v, np.full(4096, 255)), -1).astype(np.uint8).tobytes()
    slope = np.cumsum(rng.integers(0, 3, (1600, 4)), axis=0).astype(np.uint8).tobytes()
    few = bytes(np.repeat(rng.integers(0, 4, 3200), 4).astype(np.uint8))
    repeated = webp.padded(rng.integers(0, 256, 4000, dtype=np.uint8).tobytes() * 3)
    for payload, part in ((webp.padded(words), "cache"), (grey, "undo_cross_colour"), (slope, "undo_predictor"), (few, "undo_palette"), (repeated, "copy")):
        stored = webp.encode_payload(payload)
        assert part in kinds_used(stored) and webp.decode_payload(stored) == payload and len(stored) < len(payload) * 0.9


@pytest.mark.parametrize("seed", range(6))
def test_random_payloads(seed, monkeypatch):
    """Mixtures of noise, repeats and runs, also with small scans and several files."""
    rng = random.Random(seed)
    monkeypatch.setattr(webp, "SCAN", rng.choice([256, 1024, 1 << 16]))
    monkeypatch.setattr(webp, "MOST_PAYLOAD", rng.choice([64 * 50, 1 << 28]))
    for _ in range(12):
        out = bytearray()
        while len(out) < rng.choice([64, 2000, 30000]):
            k = rng.randrange(4)
            if k == 0:
                out += rng.randbytes(rng.randint(1, 300))
            elif k == 1:
                out += bytes([rng.randrange(256)]) * rng.randint(1, 2000)
            elif k == 2 and out:
                at = rng.randrange(len(out))
                out += out[at : at + rng.randint(1, 900)]
            else:
                out += bytes(rng.choice(b"aeiou tn") for _ in range(rng.randint(1, 500)))
        payload = webp.padded(bytes(out))
        assert webp.decode_payload(webp.encode_payload(payload)) == payload


def test_token_counts_against_plain_version(spark, data):
    coder, sizes = tokencount.encoder(tokencount.VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in tokencount.op10_tokencount(spark, data).collect():
        text = texts[r.doc_id]
        of_byte = [i for i, c in enumerate(text) for _ in c.encode()]
        line_of, line = [], 0
        for c in text:
            line_of.append(line)
            line += c == "\n"
        counts, crossing, at = Counter(), 0, 0
        for t in coder.encode_ordinary(text):
            chars = sorted(set(of_byte[at : at + int(sizes[t])]))
            at += int(sizes[t])
            held = Counter(line_of[c] for c in chars)
            crossing += len(held) > 1
            counts[min(held, key=lambda k: (-held[k], k))] += 1
        n = (line_of[-1] + 1) if text else 0
        assert (r.n_tokens, r.n_chars, r.n_sections, r.n_crossing, list(r.section_tokens)) == (sum(counts.values()), len(text), n, crossing, [counts[i] for i in range(n)])


def long_text(rng, words):
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    return " ".join(rng.choices(vocabulary, k=words))


def test_long_texts_are_encoded(spark):
    rng = random.Random(5)
    texts = [long_text(rng, 400_000), "".join(rng.choice("abcdefgh") for _ in range(300_000)), "é漢" * 200_000]
    coder, library = bpe.load(*bpe.rank_file()), tokencount.encoder(tokencount.VOCABULARY)[0]
    for text in texts:
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text) and coder.decode(ids) == text.encode()


def test_long_payloads_are_stored():
    rng = random.Random(6)
    payload = webp.padded(long_text(rng, 400_000).encode())
    stored = webp.encode_payload(payload)
    assert webp.decode_payload(stored) == payload and len(stored) < len(payload)


def test_long_texts_are_deduplicated(spark):
    """Texts of over a MB, so that spans end within them, against hashes of all their strings."""
    rng = random.Random(7)
    shared = long_text(rng, 30_000)
    a = long_text(rng, 160_000) + shared + long_text(rng, 5_000)
    b = long_text(rng, 20_000) + shared[1000:150_000] + "x" + shared[150_000:] + long_text(rng, 150_000)
    texts = [a.encode(), b.encode()]
    assert min(map(len, texts)) > suffixdedup.SPAN
    seen = Counter(hash(t[i : i + 400]) for t in texts for i in range(len(t) - 399))
    want = []
    for t in texts:
        step = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - 399):
            if seen[hash(t[i : i + 400])] > 1:
                step[i] += 1
                step[i + 400] -= 1
        gone = np.cumsum(step[:-1]) > 0
        want.append((len(t), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    df = spark.createDataFrame([(0, a), (1, b)], "doc_id long, text string")
    assert [tuple(r)[1:5] for r in suffixdedup.dedup(df, with_kept=False).orderBy("doc_id").collect()] == want


def test_payloads_are_written_together(monkeypatch):
    """Codes of short payloads are made at once, and each file is what its payload gives alone."""
    rng = random.Random(8)
    payloads = [webp.padded(long_text(rng, rng.randint(1, 200)).encode()) for _ in range(40)]
    payloads += [bytes(64), bytes(range(256)) * 9, rng.randbytes(6400), rng.randbytes(3200) * 2]
    alone, made, real = [webp.encode_payload(p) for p in payloads], [], webp.prefix_codes
    monkeypatch.setattr(webp, "prefix_codes", lambda *a: (made.append(1), real(*a))[1])
    assert webp.encode_payloads(payloads) == alone and len(made) == 1
    monkeypatch.setattr(webp, "BATCH", 1000)
    assert webp.encode_payloads(payloads) == alone and webp.encode_payloads([]) == []
    assert [webp.decode_payload(f) for f in alone] == payloads

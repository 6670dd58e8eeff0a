"""Suffix, line and near-duplicate removal, mixing, and the pipeline."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import jaccard, linededup, mixing, suffixdedup


def covered(texts, length=400):
    contents = [(t or "").encode() for t in texts]
    seen = Counter(c[i : i + length] for c in contents for i in range(len(c) - length + 1))
    out = []
    for c in contents:
        gone = np.zeros(len(c), bool)
        for i in range(len(c) - length + 1):
            if seen[c[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(np.frombuffer(c, np.uint8)[~gone])
        starts = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(c) else 0
        out.append((len(c), int(gone.sum()), starts, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1000, 2])
def test_suffixes_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    rng = random.Random(4)
    letters = ["ab", "cde", "fé", "g ", "hij", "\n", "漢"]
    base = "".join(rng.choice(letters) for _ in range(700))
    texts = [None, "", "a" * 399, "a" * 400, "a" * 401, "ab" * 600, base, base, base[:500] + "X" + base[500:], "Q" + base[100:500] + "Z", base[300:] * 2]
    for _ in range(25):
        x = "".join(rng.choice(letters) for _ in range(rng.randint(100, 500)))
        i, j = rng.randint(0, len(x)), rng.randint(0, 500)
        texts.append(x[:i] + base[j : j + rng.randint(100, 400)] + x[i:])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("cover", F.lit(1))
    got = [tuple(r)[1:5] for r in suffixdedup.dedup(df).orderBy("doc_id").collect()]
    assert got == covered(texts)


def in_passages(texts, length=50):
    """Windows of ``length`` words of each text that another row has too."""
    words = [(t or "").encode().split() for t in texts]
    windows = [[tuple(w[i : i + length]) for i in range(len(w) - length + 1)] for w in words]
    seen = defaultdict(set)
    for d, ws in enumerate(windows):
        for w in ws:
            seen[w].add(d)
    return [sum(len(seen[w]) > 1 for w in ws) for ws in windows]


@pytest.mark.parametrize("span", [1 << 20, 512])
def test_passages_against_brute_force(spark, monkeypatch, span):
    monkeypatch.setattr(suffixdedup, "SPAN", span)
    monkeypatch.setattr(suffixdedup, "_UP", suffixdedup._powers(suffixdedup._POWER, span))
    monkeypatch.setattr(suffixdedup, "_DOWN", suffixdedup._powers(suffixdedup._INVERSE, span))
    rng = random.Random(8)
    words = lambda n: [rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice(["", "é"]) for _ in range(n)]
    passage = {n: words(n) for n in (49, 50, 51, 75, 200)}
    texts = [None, "", " ".join(words(40)), "x" * 700, " ".join(["x" * 700] * 60)]
    for p in passage.values():
        texts += [" ".join(words(rng.randint(0, 90)) + p + words(rng.randint(0, 90))) for _ in range(2)]
    texts += ["\n".join(words(5) + passage[200][20:90] + words(5)), " ".join(words(60) * 2), texts[5], " ".join(words(70))]
    texts += [texts[-1]] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = suffixdedup.dedup(df).orderBy("doc_id").collect()
    assert [r.passage_windows for r in got] == in_passages(texts)
    assert [tuple(r)[1:5] for r in got] == covered(texts)


def test_suffixes_odd_rows(odd, none):
    rows = suffixdedup.dedup(odd).collect()
    assert len(rows) == odd.count() and suffixdedup.dedup(none).count() == 0
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[3].n_bytes == 0 and by_id[8].n_removed == by_id[8].n_bytes


def test_multikey_sort():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 4, 500) for _ in range(3)]
    order = suffixdedup.multikey_sort(columns)
    rows = list(zip(*(c[order].tolist() for c in columns), strict=True))
    assert rows == sorted(rows)


def recurring_plain(docs, depth, least, similar):
    """The rules of line dedup, read literally."""
    def tokens(line):
        return ["<*>" if any(c in "0123456789" for c in t) else t for t in line.split()]

    lines = [(d, tuple(tokens(x))) for d, text in docs for x in text.split("\n") if x.strip()]
    by_line, by_leaf = defaultdict(set), defaultdict(lambda: defaultdict(set))
    for d, t in lines:
        by_line[t].add(d)
        by_leaf[len(t), t[:depth]][t].add(d)
    first = {t: min(ds) for t, ds in by_line.items() if len(ds) >= least}
    for leaf in by_leaf.values():
        total = sum(map(len, leaf.values()))
        if total < least or len(leaf) < 2:
            continue
        size = len(next(iter(leaf)))
        fixed = {}
        for p in range(size):
            votes = Counter()
            for t, ds in leaf.items():
                votes[t[p]] += len(ds)
            word, n = votes.most_common(1)[0]
            if 2 * n > total:
                fixed[p] = word
        members = [t for t in leaf if sum(fixed.get(p) == w for p, w in enumerate(t)) >= similar * size]
        whole = set().union(*(leaf[t] for t in members)) if members else set()
        if len(whole) >= least:
            first |= {t: min(whole) for t in members}
    return {d: "\n".join(x for x in text.split("\n") if not x.strip() or tuple(tokens(x)) not in first or first[tuple(tokens(x))] == d) for d, text in docs}


def test_lines_against_plain_version(spark):
    rng = random.Random(2)
    docs = []
    for d in range(40):
        own = ["own " + " ".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3)]
        shared = [f"Page {d} of 40", f"The user {rng.choice(['ann', 'bob', 'eve'])} logged in at noon today", "Same line here", ""]
        docs.append((d, "\n".join(rng.sample(own + shared, 5))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.row.doc_id: r.kept for r in linededup.dedup_lines(df, min_docs=5).collect()}
    assert got == recurring_plain(docs, linededup.DEPTH, 5, linededup.SIMILAR)
    assert any(got[d] != t for d, t in docs)


def test_long_lines_in_few_documents(spark, tmp_path):
    rng = random.Random(7)
    words = lambda n: " ".join(rng.choice("abcdefghijklmnop") + rng.choice("0xyz") for _ in range(n))
    passages = {n: words(60) for n in range(2, 10)}
    short, own = words(49), words(80)
    docs = []
    for d in range(12):
        docs.append((d, "\n".join([words(70), own if d == 0 else words(5)] + [p for n, p in passages.items() if d < n] + ([short] if d < 9 else []) + ([own] if d == 0 else []))))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.row.doc_id: r.kept for r in linededup.dedup_lines(df).collect()}
    assert kept == {d: "\n".join(x for x in t.split("\n") if d == 0 or x not in passages.values()) for d, t in docs}
    dropped = {r.doc_id: r.n_dropped for r in linededup.op6_linededup(spark, str(tmp_path)).collect()}
    assert dropped == {d: sum(0 < d < n for n in passages) for d, _ in docs}


def test_lines_odd_rows(spark, odd, none):
    assert linededup.dedup_lines(odd, min_docs=2).count() == odd.count()
    out = linededup.stage(spark, odd, "")
    assert out.schema == odd.schema and out.count() == odd.count()
    assert linededup.stage(spark, none, "").count() == 0
    kept = {r.row.doc_id: r.kept for r in linededup.dedup_lines(odd.where("doc_id IS NOT NULL"), min_docs=2).collect()}
    assert kept[1] and kept[2] == "" and kept[3] is None and kept[6] == " \n\t "


def jaccards(texts):
    sets = [jaccard.shingle_set(t) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i]) and jaccard.jaccard(sets[i], sets[j]) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


def test_classes_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = jaccards([d.text for d in docs])
    got = {r.doc_id: r.class_id for r in jaccard.op5_jaccard(spark, data).collect()}
    assert [got[d.doc_id] for d in docs] == [docs[w].doc_id for w in want]
    assert len(set(want)) < len(docs)


def test_classes_of_many_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    texts = []
    for _ in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(300)] = f"x{rng.randint(0, 99999)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"u{rng.randint(0, 5000)}" for _ in range(100)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.class_id for r in jaccard.classes(df).orderBy("doc_id").collect()]
    assert got == jaccards(texts)
    assert jaccard.keep_one(df).count() == 31


def linked(texts):
    """Links of every text to other texts, by unrestricted brute force over different shingle sets."""
    sets = [jaccard.shingle_set(t) for t in texts]
    different = {s.tobytes(): s for s in sets if len(s)}
    count = {k: sum(jaccard.jaccard(s, o) >= 0.8 for m, o in different.items() if m != k) for k, s in different.items()}
    return [count.get(s.tobytes(), 0) for s in sets]


@pytest.mark.parametrize("options", [{}, {"crowd": 3, "block": 20}, {"crowd": 10_000}])
def test_links_against_brute_force(spark, options):
    rng = random.Random(11)
    texts = []
    for size, own in ((90, 2), (70, 27), (12, 2)):  # mutually near, crowded about the threshold, few
        base = [f"w{rng.randint(0, 9999)}" for _ in range(300)]
        tails = [[f"t{rng.randint(0, 99999)}" for _ in range(own)] for _ in range(size)]
        texts += [" ".join(base + t if rng.random() < 0.5 else t + base) for t in tails]
    base = [f"w{rng.randint(0, 9999)}" for _ in range(300)]
    texts += [" ".join(base + [f"s{rng.randint(0, 99999)}" for _ in range(60)]) for _ in range(70)]  # alike, all below the threshold
    texts += texts[:3] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = jaccard.classes(df, **options).orderBy("doc_id").collect()
    assert [r.n_links for r in got] == linked(texts)
    assert max(r.n_links for r in got) > 80 and [r.class_id for r in got] == jaccards(texts)


def test_classes_odd_rows(odd, none):
    rows = jaccard.classes(odd).collect()
    assert len(rows) == odd.count() and jaccard.classes(none).count() == 0
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].class_id == by_id[2].class_id == 1 and by_id[3].class_id == 3 and by_id[5].class_id == 5
    assert by_id[8].class_id == by_id[9].class_id == 8
    kept = jaccard.keep_one(odd)
    assert kept.schema == odd.schema and Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 5, 6, 7, 8, 10, None, None])


def test_components(spark):
    links = [(b"a", b"b"), (b"c", b"d"), (b"b", b"c"), (b"x", b"y")] + [(b"h%02d" % i, b"h%02d" % (i + 1)) for i in range(30)]
    got = {bytes(r.node): bytes(r.root) for r in jaccard.components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert got[b"d"] == b"a" and got[b"y"] == b"x" and got[b"h30"] == b"h00"


def goals(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by sharing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), list(names)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        out = {s: out[s] + (left * w[s] / total if s in open_ else 0) for s in names}
        left = 0.0
        for s in list(open_):
            if out[s] >= cap * sizes[s]:
                left += out[s] - cap * sizes[s]
                out[s] = cap * sizes[s]
                open_.remove(s)
    return out


def test_mix_meets_targets(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = mixing.op2_mixing(spark, data).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.size == len([x for x in __import__("re").split(r"[\x20\x09-\x0D]+", docs.where(f"doc_id = {r.doc_id}").first().text) if x]) if r.doc_id < 3 else True
    for s, goal in goals(sizes).items():
        assert all(abs(r.target - goal) < 1e-6 * max(1, goal) for r in rows if r.source == s)
        assert abs(taken[s] - goal) <= 2
    again = mixing.op2_mixing(spark, data).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixing.op2_mixing(spark, data).collect()))


def test_mix_odd_rows(spark, odd, none):
    out = mixing.draw(odd, [F.col("doc_id")]).collect()
    assert len(out) == odd.count()
    assert all(r.taken == 0 for r in out if r.doc_id in (3, 5, 6))
    mixed = mixing.mix(odd)
    assert mixed.schema == odd.schema and mixing.mix(none).count() == 0
    assert 0 < mixed.count() <= 2 * odd.count()


def test_split_tree_keeps_quotas(spark):
    quotas = {0: 17, 1: 5, 2: 1, 3: 40}
    rows = mixing.split_tree(spark.createDataFrame(list(quotas.items()), "idx int, quota long"), 3).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        by_source[r.idx] += r.n
        by_shard[r.shard] += r.n
    assert by_source == quotas and len(by_shard) == 8 and max(by_shard.values()) - min(by_shard.values()) <= 1


def test_pipeline_against_plain_versions(spark, data, tmp_path):
    import tiktoken

    import corpus_pipeline
    from quire.llm import bpe

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, kept = docs.columns, {"": docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, data)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    texts = {n: sorted(((r.doc_id, r.text) for r in rows)) for n, rows in kept.items() if n != "bpe"}
    assert texts["language_id"] == texts[""]
    lines = recurring_plain(texts["language_id"], linededup.DEPTH, linededup.MIN_DOCS, linededup.SIMILAR)
    assert texts["line_dedup"] == sorted((d, t) for d, t in lines.items() if t.strip() or t == dict(texts[""])[d])
    roots = jaccards([t for _, t in texts["line_dedup"]])
    assert texts["near_duplicates"] == [texts["line_dedup"][i] for i in sorted(set(roots))]
    assert set(texts["source_mixing"]) <= set(texts["near_duplicates"]) and max(Counter(texts["source_mixing"]).values()) <= 2
    sizes, drawn, longest = Counter(), Counter(), Counter()
    for r in kept["near_duplicates"]:
        n = len(r.text.split())
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in kept["source_mixing"]:
        drawn[r.source] += len(r.text.split())
    for source, goal in goals(sizes).items():
        assert goal - 1 <= drawn[source] <= goal + 2 * longest[source] + 1  # a document within which the quota ends stays whole
    path, pattern = bpe.rank_file()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load(path, pattern).ranks, special_tokens={})
    assert Counter((r.doc_id, r.n_tokens) for r in kept["bpe"]) == Counter((d, len(library.encode_ordinary(t))) for d, t in texts["source_mixing"])
    whole = corpus_pipeline.run(spark, data)
    assert sorted(map(str, whole.collect())) == sorted(map(str, kept["bpe"]))

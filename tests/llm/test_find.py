"""Language ID, top-k and WARC."""

import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import langid, topk, warc


def test_language_accuracy(spark, data):
    found = langid.op1_langid(spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id")
    kept = found.where("held_out").collect()
    assert len(kept) > 10 and sum(r.lang == r.lang_pred for r in kept) / len(kept) > 0.95
    assert all(0 <= r.score <= 1 for r in found.collect())


def test_language_odd_rows(odd, none):
    model = langid.fit(odd)
    rows = langid.identify(odd, model).collect()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == odd.count()
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (3, 5, 6, 7))
    assert by_id[1].lang_pred == "en"
    assert langid.identify(none, model).count() == 0
    empty = langid.fit(none)
    assert {r.lang_pred for r in langid.identify(odd, empty).collect()} == {"und"}
    kept = langid.stage(None, odd, "")
    assert kept.schema == odd.schema and {r.doc_id for r in kept.collect()} == {1, 2, None, 8, 9, 10}


def test_spans_of_mixed_text():
    model = langid.Model({"en": {" th": 50, "the": 50, "he ": 40, "and": 20, " an": 20, "nd ": 20}, "ru": {" и ": 5, " на": 9, "на ": 9}}, {"en": 3, "ru": 1})
    pred, score, spans = langid.label(model, "the and the and на на на на на the the the the the 漢字")
    assert pred == "en" and [s[0] for s in spans][:3] == ["en", "ru", "en"] and 0 < score < 1
    assert langid.label(model, "漢字 漢字")[0] == "en"


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    scores, penalty = rng.normal(0, 6, (6, 3)), 5.0
    paths = np.stack(np.meshgrid(*[range(3)] * 6, indexing="ij"), -1).reshape(-1, 6)
    value = lambda p: scores[range(6), p].sum() - penalty * (np.diff(p) != 0).sum()
    assert abs(max(map(value, paths)) - value(langid.viterbi(scores, penalty))) < 1e-9


@pytest.mark.parametrize("seed", range(8))
def test_top_k_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    n, d = (300, 5) if seed % 2 else (2000, 16)
    cand, ids = rng.integers(-4, 5, (n, d)), rng.permutation(n)
    for (i, s), q in zip(topk.search(cand, ids, cand[:40], ids[:40], 20), range(40), strict=True):
        scores = cand @ cand[q]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:20]
        assert i.tolist() == ids[order].tolist() and s.tolist() == scores[order].tolist()


def test_top_k_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (None, [1.0, 1.0]), (40, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.usable(F.col("embedding")).alias("v")).where("v IS NOT NULL AND vec_id IS NOT NULL")
    out = topk.top_k(df, df.where("vec_id % 20 = 0"), 3).orderBy("query_id", "rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in out if r.query_id == 0] == [(1, 1, 4096), (2, 2, 4096), (3, 20, 2048)]
    assert {r.vec_id for r in out} <= {0, 1, 2, 7, 20, 40}
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_components_of_any_size(spark, seed):
    """All scores by whole numbers, with vectors that no 64-bit sum holds among small ones."""
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(0, 1, 3) * rng.choice([1, 1, 1, 2.0**21, 2.0**40, 1e19], p=[0.5, 0.2, 0.1, 0.1, 0.05, 0.05]) * (rng.random(3) < 0.8)).tolist()) for i in range(60)]
    whole = {i: [int(np.floor(64 * x)) if abs(x) < 2**40 else int(x) * 64 for x in v] for i, v in rows}
    want = []
    for q in range(0, 60, 20):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i) for i in whole if i != q)[:20]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, start=1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", topk.usable(F.col("embedding")).alias("v"))
    if all(-(2**63) <= w[3] < 2**63 for w in want):
        assert sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 20 = 0"), shard_rows=25, query_rows=2).collect()) == want
    else:
        with pytest.raises(Exception, match="leaves the range"):
            topk.top_k(df, df.where("vec_id % 20 = 0"), shard_rows=25, query_rows=2).collect()
        found = topk.best_in_cell(np.array([v for _, v in rows]), np.arange(60), np.array([rows[q][1] for q in (0, 20, 40)]), np.array([0, 20, 40]), 20, 64)
        assert [(q, n, i, s) for q, (ids, scores) in zip((0, 20, 40), found, strict=True) for n, (i, s) in enumerate(zip(ids, scores, strict=True), start=1)] == want


def test_bound_stops_early():
    """With components of very different size few vectors are met."""
    rng = np.random.default_rng(1)
    cand = np.floor(rng.pareto(0.7, (4000, 6)) * 3).clip(0, 1e5).astype(np.int64)
    stops: list[int] = []
    found = topk.search(cand, np.arange(4000), cand[:50], np.arange(50), 5, stops)
    assert len(stops) == 50 and np.mean(np.array(stops) < 4000) > 0.9
    for (i, s), q in zip(found, range(50), strict=True):
        scores = cand @ cand[q]
        order = [j for j in np.lexsort((np.arange(4000), -scores)) if j != q][:5]
        assert i.tolist() == order and s.tolist() == scores[order].tolist()


def test_warc_revisits(spark):
    same = b"p" * 150
    rows = [(5, "http://a/\r\nX: y", same), (3, "http://b/", same), (9, None, same), (None, "u", same), (1, "u", b"short"), (2, "u", b"short"), (4, "u", None), (3, "http://b/", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, payload binary").withColumn("digest", F.lit("clash"))
    records = warc.read_archives(warc.deduplicate(pages, archive_bytes=600))
    out = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.resolve(records).collect()}
    assert out == {(3, "response", None, 150), (5, "revisit", 3, 150), (9, "revisit", 3, 150), (None, "revisit", 3, 150), (1, "response", None, 5), (2, "response", None, 5), (4, "response", None, 0)}
    assert warc.resolve(warc.read_archives(warc.deduplicate(pages.limit(0)))).count() == 0


def test_warc_record_parses():
    data = warc.record(7, "http://x/", b"body\r\n\r\nmore", "d" * 64, None, False)
    fields, block = warc.parse(io.BytesIO(data + data))
    assert fields["warc-type"] == "response" and block.partition(b"\r\n\r\n")[2] == b"body\r\n\r\nmore"
    assert warc.parse(io.BytesIO(b"")) is None
    with pytest.raises(ValueError):
        warc.parse(io.BytesIO(data[:-20]))

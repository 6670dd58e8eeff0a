"""Exact top-k inner-product search by the threshold algorithm.

Candidates are dealt to shards. Within a shard every dimension has a list of the vectors sorted by that component; a query walks
the lists of its non-zero components from their better end, scores each vector it meets for the first time with all components
(random access), and stops once its k-th score beats the bound: the score of a vector that would stand at the current depth in
every list. Each shard's answers are exact, so their merge is.

Queries and candidates are both dealt to blocks, and a task holds one block of each, so that neither side is broadcast and a
task's memory does not depend on the size of the tables.

Components are exact: scores of vectors whose components are small enough for 64-bit sums (``LIMIT``) are, others are scored with
whole numbers of any size against all partners in the cell; only a score among the best that leaves the range of a long is an
error. Where no bound can stop a query early, as with vectors of random directions, a query meets all vectors of a shard.

Defined cases: vectors that are null or hold a null or non-finite component take no part; a missing component counts as 0 where
lengths differ; an empty vector scores 0; equal scores go by the smaller id; rows with a query's own id are not its candidates; of
rows that share a query's id, the smallest vector asks; repeated candidates stay; rows with a null id can't be named and take no
part; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 20
SCALE = 64
QUERY_EVERY = 20
SHARD_ROWS = 4096
QUERY_ROWS = 1024
LIMIT = 1 << 26
#: Depths at which a query looks at its bound: the first, and each so many times the one before.
FIRST_DEPTH, DEEPER = 16, 4
#: Cells are dealt to at most so many partitions; a partition then works on several cells, one after another.
PARTITIONS = 100_000


def usable(vector: Column, scale: int = SCALE) -> Column:
    """The components as doubles; null if the vector takes no part. Where the scale is a power of two they are cut to what the scale
    keeps, which changes no score and leaves less to shuffle."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))

    def short(x):
        y = x.cast("double")
        return y if scale & (scale - 1) else F.when(F.abs(y) < float(1 << 40), F.floor(y * scale).cast("double") / scale).otherwise(y)

    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, short))


def depths(n: int) -> list[int]:
    out = [FIRST_DEPTH]
    while out[-1] < n:
        out.append(out[-1] * DEEPER)
    return [*(d for d in out if d < n), n]


def search(cand: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, stops: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its k best candidates, best first; all arrays hold integers. ``stops`` gets the depths at
    which queries stopped."""
    order_of_ids = np.argsort(ids, kind="stable")
    cand, ids = cand[order_of_ids], ids[order_of_ids]
    n, d = cand.shape
    down = np.argsort(-cand, axis=0, kind="stable")  # the sorted list of each dimension
    small = float(np.abs(cand).max(initial=0)) * float(np.abs(queries).max(initial=0)) * d
    dot = (lambda a, b: (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)) if small < 2**53 else (lambda a, b: a @ b.T)
    assert small < 2**63, "scores exceed 64 bits"
    out: list = []
    for lo in range(0, len(queries), 128):
        q, q_ids = queries[lo : lo + 128], query_ids[lo : lo + 128]
        rows = np.arange(len(q))
        best_s, best_i = [np.empty(0, np.int64)] * len(q), [np.empty(0, np.int64)] * len(q)
        seen, last = np.zeros(n, bool), 0
        for depth in depths(n):
            active = q[rows]
            up, dn = np.flatnonzero((active > 0).any(0)), np.flatnonzero((active < 0).any(0))
            met = np.zeros(n, bool)
            met[down[last:depth][:, up].ravel()] = True
            met[down[n - depth : n - last][:, dn].ravel()] = True
            if depth == n:
                met[:] = True
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            scores = dot(active, cand[fresh])
            bound = np.where(active > 0, active * cand[down[depth - 1], np.arange(d)], 0).sum(1) + np.where(active < 0, active * cand[down[n - depth], np.arange(d)], 0).sum(1)
            going = []
            for at, r in enumerate(rows):
                s = scores[at]
                own = ids[fresh] != q_ids[r]
                floor = best_s[r][-1] if len(best_s[r]) >= k else None
                keep = np.flatnonzero(own if floor is None else own & (s >= floor))
                if len(keep) > 4 * k:
                    keep = keep[s[keep] >= np.partition(s[keep], -k)[-k]]
                s_all, i_all = np.concatenate((best_s[r], s[keep])), np.concatenate((best_i[r], ids[fresh[keep]]))
                top = np.lexsort((i_all, -s_all))[:k]
                best_s[r], best_i[r] = s_all[top], i_all[top]
                if len(top) < k or best_s[r][-1] <= bound[at]:  # an unseen equal score may have a smaller id
                    going.append(r)
            if stops is not None:
                stops += [depth] * (len(rows) - len(going) if depth < n else len(rows))
            rows, last = np.array(going, int), depth
            if not len(rows) or depth == n:
                break
        out.extend(zip(best_i, best_s, strict=True))
    return out


def _matrix(lists: list, d: int) -> np.ndarray:
    m = np.zeros((len(lists), d))
    for i, x in enumerate(lists):
        m[i, : len(x)] = x
    return m


def whole(x: float, scale: int) -> int:
    """floor(scale * x), also where the product is no double."""
    return math.floor(scale * x) if abs(x) < 1 << 40 else int(x) * scale


def _wide(vectors: np.ndarray, ids: np.ndarray, asker: np.ndarray, asker_id: int, k: int, scale: int) -> tuple[list[int], list[int]]:
    """The k best of some candidates for one query, with whole numbers of any size."""
    q = [whole(x, scale) for x in asker.tolist()]
    scores = ((-sum(a * whole(x, scale) for a, x in zip(q, row, strict=True) if a), i) for row, i in zip(vectors.tolist(), ids.tolist(), strict=True) if i != asker_id)
    best = heapq.nsmallest(k, scores)
    return [i for _, i in best], [-s for s, _ in best]


def best_in_cell(cand: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, scale: int) -> list[tuple[list[int], list[int]]]:
    """For each query the ids and scores of its k best candidates; all arrays of vectors hold unscaled components."""
    limit = min(LIMIT, math.isqrt((1 << 62) // max(1, cand.shape[1])))
    small_c, small_q = ((np.abs(m) * scale <= limit - 1).all(1) for m in (cand, queries))
    scaled = lambda m: np.floor(m * scale).astype(np.int64)
    out: list = [([], [])] * len(queries)
    if small_c.any() and small_q.any():
        found = search(scaled(cand[small_c]), ids[small_c], scaled(queries[small_q]), query_ids[small_q], k)
        for at, (i, s) in zip(np.flatnonzero(small_q).tolist(), found, strict=True):
            out[at] = i.tolist(), s.tolist()
    for at in range(len(queries)):
        others = ~small_c if small_q[at] else np.ones(len(cand), bool)
        if others.any():
            i, s = _wide(cand[others], ids[others], queries[at], int(query_ids[at]), k, scale)
            best = sorted((-b, a) for a, b in zip(out[at][0] + i, out[at][1] + s, strict=True))[:k]
            out[at] = [a for _, a in best], [-b for b, _ in best]
    return out


def _cell(k, scale):
    def run(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy(zero_copy_only=False)
        ids, lists = table.column("vec_id").to_numpy(), table.column("v").to_pylist()
        m = _matrix(lists, max(1, max(map(len, lists))))
        found = best_in_cell(m[~is_query], ids[~is_query], m[is_query], ids[is_query], k, scale) if is_query.any() and not is_query.all() else []
        asked = [i for i, (best, _) in zip(ids[is_query].tolist(), found, strict=False) for _ in best]
        scores = [s for _, best in found for s in best]
        held = [min(max(s, -(1 << 63)), (1 << 63) - 1) for s in scores]
        beyond = [a != b for a, b in zip(scores, held, strict=True)]
        return pa.table({"query_id": pa.array(asked, pa.int64()), "vec_id": pa.array([i for best, _ in found for i in best], pa.int64()), "score": pa.array(held, pa.int64()), "beyond": pa.array(beyond, pa.bool_())})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, scale: int = SCALE) -> DataFrame:
    """vectors and queries: vec_id long, v array<double> (null vectors already gone). query_id, rank, vec_id, score."""
    asks = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_shards, n_blocks = max(1, -(-vectors.count() // shard_rows)), max(1, -(-asks.count() // query_rows))
    deal = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    left = vectors.select("vec_id", "v", F.lit(False).alias("is_query"), F.pmod(F.xxhash64(F.lit(1), "vec_id", "v"), F.lit(n_shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    right = asks.select("vec_id", "v", F.lit(True).alias("is_query"), F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), deal(2, n_blocks).alias("block"))
    cells = left.unionByName(right).repartition(min(n_shards * n_blocks, PARTITIONS), "shard", "block")
    near = cells.groupBy("shard", "block").applyInArrow(_cell(k, scale), "query_id long, vec_id long, score long, beyond boolean")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    score = F.when(F.col("beyond"), F.raise_error(F.lit("a score leaves the range of a long")).cast("long")).otherwise(F.col("score"))
    return near.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))


def op8_topk(spark, sf_dir: str) -> DataFrame:
    """For every vector whose id is divisible by 20 its 20 best partners among all vectors."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long"), usable(F.col("embedding")).alias("v")).where("v IS NOT NULL AND vec_id IS NOT NULL")
    return top_k(rows, rows.where(F.col("vec_id") % QUERY_EVERY == 0))


SQL = {
    "op8_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score FROM c AS q JOIN c ON q.d = c.d AND q.vec_id <> c.vec_id
      WHERE q.vec_id % 20 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20"""
}

"""Near-duplicate join: Jaccard similarity of word shingles by a MinHash LSH forest.

* Documents with one shingle set are one node (exact classes, by a 128-bit hash of the set), counted before anything is compared.
* Forest: each of ``TREES`` trees has a label of ``LABEL`` MinHash values a node. All nodes whose labels share a prefix in some tree
  are candidates of each other; prefixes are shortened from the whole label until the chance that two texts at the threshold share
  one in some tree reaches ``RECALL`` (``prefix_length``). A prefix's nodes are dealt to one partition, so no border cuts them.
* A prefix of up to ``CROWD`` nodes gives all its pairs as rows. The nodes of a larger one are joined to a group (with all that
  they share another crowded prefix with), a hash deals a group to blocks of about ``BLOCK`` nodes or ``BLOCK_BYTES``, and a task
  compares all pairs of two blocks at once. So no pair is left out, and rows are nodes times blocks, not pairs.
* Every candidate pair is verified on the whole texts' shingle sets. Links join nodes to classes (connected components, by
  minimum labels with pointer jumping, a checkpoint each round).

``n_links`` counts the verified links of a document's text to different texts; copies of one text are not expanded. Words are runs of word characters in lower case; a text of fewer than ``SHINGLE`` words is one shingle.

Defined cases: a null text, or one without words, is a class of its own; rows with a null id are named by a hash of their text and never
represent a class that has another id; repeated rows are one document, of which ``keep_one`` keeps one row; ties go to the
smallest id; extra columns, whatever their names, pass through ``keep_one``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, cut, discard, give_back, light, remembers, slices, stored

SHINGLE, THRESHOLD = 5, 0.8
TREES, LABEL, RECALL = 24, 8, 0.9995
CROWD, BLOCK = 16, 2048
#: Bytes of text of a block, and shingles that are compared at a time.
BLOCK_BYTES, COLUMNS = 8 << 20, 2048
CACHE_ENTRIES = 400_000
WORDS = re.compile(r"\w+")
_seed = np.random.Generator(np.random.PCG64(5))
_XOR = _seed.integers(0, 2**64, TREES * LABEL, np.uint64)
_MUL = _seed.integers(0, 2**63, TREES * LABEL, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, label: int = LABEL) -> int:
    """The longest prefix at which a pair at the threshold is found with the wanted chance."""
    for d in range(label, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


class _Hashes(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word):
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of k words."""
    words = WORDS.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64)
    if len(_hashes) > CACHE_ENTRIES:
        _hashes.clear()
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ w[i : len(w) - k + 1 + i]) * _STEP
        h ^= h >> np.uint64(29)
    h *= _LAST
    return np.unique(h ^ (h >> np.uint64(32)))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def signature(shingles: np.ndarray) -> bytes:
    """The labels of all trees, two bytes a MinHash value."""
    least = np.full(TREES * LABEL, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 1024):
        part = shingles[lo : lo + 1024]
        np.minimum(least, ((part[None, :] ^ _XOR[:, None]) * _MUL[:, None]).min(1), out=least)
    return ((least * _LAST) >> np.uint64(48)).astype(">u2").tobytes()


def _signatures(batches):
    remembers("jaccard", _hashes.clear)
    for batch in slices(batches):
        nodes, labels = [], []
        for text in batch.column(2).to_pylist():
            s = shingle_set(text)
            nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            labels.append(signature(s) if len(s) else None)
        yield [batch.column(0), batch.column(1), nodes, labels]
    _hashes.clear()
    give_back()


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary array."""
    n, size = rows.shape
    offsets = np.arange(0, (n + 1) * size, size, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, size)


def _tries(batches, depth):
    """One row a tree of each node: the tree's number and the prefix of its label, then the node."""
    for batch in slices(batches, 1 << 20):
        node, labels = _matrix(batch.column(0), 16), _matrix(batch.column(1), TREES * LABEL * 2)
        n = len(node)
        out = np.empty((n, TREES, 1 + 2 * depth), np.uint8)
        out[:, :, 0] = np.arange(TREES)
        out[:, :, 1:] = labels.reshape(n, TREES, 2 * LABEL)[:, :, : 2 * depth]
        yield [_binary(out.reshape(n * TREES, -1)), _binary(np.repeat(node, TREES, axis=0))]


def _candidates(batches, depth, crowd):
    """From rows sorted by prefix and node all pairs under one prefix (a < b); of a prefix with more than ``crowd`` nodes, each with
    the first. The run that is open at a batch's end is carried on, of a crowded one the first node."""
    size = 1 + 2 * depth
    held_p, held_n, crowded = np.empty((0, size), np.uint8), np.empty((0, 16), np.uint8), False

    def rows(nodes, starts, sizes, first_crowded):
        left, right, many = [], [], []
        big = sizes > crowd
        if len(big):
            big[0] |= first_crowded
        for m in np.unique(sizes[~big]).tolist():
            if m > 1:
                at = starts[~big & (sizes == m)]
                i, j = np.triu_indices(m, 1)
                left.append(nodes[(at[:, None] + i).ravel()])
                right.append(nodes[(at[:, None] + j).ravel()])
                many.append(np.zeros(len(at) * len(i), bool))
        for at, m in zip(starts[big].tolist(), sizes[big].tolist(), strict=True):
            left.append(np.repeat(nodes[at : at + 1], m - 1, axis=0))
            right.append(nodes[at + 1 : at + m])
            many.append(np.ones(m - 1, bool))
        if left:
            yield [_binary(np.concatenate(left)), _binary(np.concatenate(right)), pa.array(np.concatenate(many))]

    for batch in batches:
        if not batch.num_rows:
            continue
        prefix = np.concatenate((held_p, _matrix(batch.column(0), size)))
        nodes = np.concatenate((held_n, _matrix(batch.column(1), 16)))
        starts = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]).any(1)])
        sizes = np.diff(np.r_[starts, len(nodes)])
        yield from rows(nodes, starts[:-1], sizes[:-1], crowded)
        last, crowded = starts[-1], crowded and len(starts) == 1
        held_p, held_n = prefix[last:], nodes[last:]
        if crowded or len(held_n) > crowd:
            yield from rows(held_n, np.array([0]), np.array([len(held_n)]), True)
            held_p, held_n, crowded = held_p[:1], held_n[:1], True
    if len(held_n) > 1:
        yield from rows(held_n, np.array([0]), np.array([len(held_n)]), crowded)


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of some sets shares with each of others, by products of 0/1 matrices over some shingles at a time."""
    both = np.zeros((len(left), len(right)), np.float32)
    names = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def places(sets):
        """Row and column of the shingles that both sides have, by column."""
        every, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.minimum(np.searchsorted(names, every), max(0, len(names) - 1))
        kept = names[column] == every if len(names) else np.zeros(len(every), bool)
        order = np.argsort(column[kept], kind="stable")
        return row[kept][order], column[kept][order]

    (row_l, column_l), (row_r, column_r) = places(left), places(right)
    for lo in range(0, len(names), COLUMNS):
        sides = []
        for row, column, n in ((row_l, column_l, len(left)), (row_r, column_r, len(right))):
            i, j = np.searchsorted(column, (lo, lo + COLUMNS))
            m = np.zeros((n, COLUMNS), np.float32)
            m[row[i:j], column[i:j] - lo] = 1
            sides.append(m)
        both += sides[0] @ sides[1].T
    return both


def _block_pair(threshold):
    """All pairs of two blocks (of one, within it): each linked node with its number of links and a root it is connected with."""

    def run(table: pa.Table) -> pa.Table:
        remembers("jaccard", _hashes.clear)
        table = table.sort_by("node")  # the smallest node is the root, the same in many block pairs
        nodes, block = table.column("node").to_pylist(), table.column("block").to_numpy()
        one = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        sets = [shingle_set(t) for t in table.column("text").to_pylist()]
        left = np.flatnonzero(block == block.min())
        right = left if one else np.flatnonzero(block != block.min())
        if not len(right):
            left = left[:0]
        near = np.zeros((len(left), len(right)), bool)
        if len(left):
            sizes = np.array([len(s) for s in sets], np.float64)
            both = shared([sets[i] for i in left], [sets[i] for i in right])
            near = alike(both, sizes[left], sizes[right], threshold)
        if one:
            np.fill_diagonal(near, False)
        n = np.zeros(len(nodes), np.int64)
        n[left] += near.sum(1)
        if not one:
            n[right] += near.sum(0)
        root = np.arange(len(nodes), dtype=np.int32)
        while len(left):
            least = root.copy()
            least[left] = np.minimum(least[left], np.where(near, root[right][None, :], len(nodes)).min(1))
            least[right] = np.minimum(least[right], np.where(near, root[left][:, None], len(nodes)).min(0))
            least = least[least]
            if (least == root).all():
                break
            root = least
        at = np.flatnonzero(n)
        return pa.table({"node": pa.array([nodes[i] for i in at], pa.binary()), "root": pa.array([nodes[root[i]] for i in at], pa.binary()), "n": pa.array(n[at], pa.int64())})

    return run


def alike(both: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """The test of ``jaccard`` for all pairs, a row at a time."""
    out = np.empty(both.shape, bool)
    for i, row in enumerate(both):
        row = row.astype(np.float64)
        out[i] = row / (left[i] + right - row) >= threshold
    return out


def _verified(batches, threshold):
    known: dict[bytes, np.ndarray] = {}
    remembers("jaccard", _hashes.clear)

    def sets(node, text):
        found = known.get(node)
        if found is None:
            if len(known) > 256:
                known.clear()
            found = known[node] = shingle_set(text)
        return found

    for batch in slices(batches):
        a, b, ta, tb = (c.to_pylist() for c in batch.columns)
        good = [jaccard(sets(x, s), sets(y, t)) >= threshold for x, y, s, t in zip(a, b, ta, tb, strict=True)]
        kept = batch.filter(pa.array(good, pa.bool_()))
        yield [kept.column(0), kept.column(1)]


def components(links: DataFrame) -> DataFrame:
    """node, root of every node of the undirected links (a, b): the smallest node that it is connected with."""
    both = stored(links.union(links.select("b", "a")).toDF("node", "other"), "links")
    now = cut(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        near = both.join(now.select(F.col("node").alias("other"), F.col("root").alias("r")), "other").groupBy("node").agg(F.min("r").alias("r"))
        step = now.join(near, "node").select("node", "root", F.least("root", "r").alias("next"))
        jump = now.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        after = cut(step.join(jump, "next").select("node", F.col("root").alias("before"), F.least("next", "beyond").alias("root")))
        changed = after.where("root <> before").limit(1).count()
        now = after.select("node", "root")
        if not changed:
            discard(both)
            return now


def _named(docs: DataFrame):
    """A name for each document: its id, or a hash of its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))))


def links(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, crowd: int = CROWD, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, name, node), links (a, b) that connect all nodes with a path of verified pairs, and each linked node's
    number of verified pairs (node, n_links)."""
    text = F.col("text").cast("string")
    signed = stored(arrow_map(docs.select(F.col("doc_id").cast("long"), _named(docs).alias("name"), text), "doc_id long, name long, node binary, labels binary", _signatures), "signatures")
    found = stored(signed.drop("labels"), "documents")
    nodes = cut(signed.where("node IS NOT NULL").groupBy("node").agg(F.min("name").alias("name"), F.first("labels").alias("labels")))
    discard(signed)
    depth = prefix_length(threshold, recall)
    tries = arrow_map(nodes.select("node", "labels"), "label binary, node binary", lambda batches: _tries(batches, depth))
    ordered = tries.repartition("label").sortWithinPartitions("label", "node")
    met = cut(arrow_map(ordered, "a binary, b binary, crowded boolean", lambda batches: _candidates(batches, depth, crowd)).distinct())
    groups = components(met.where("crowded").select("a", "b")).withColumnRenamed("root", "grp")
    near = groups.select(F.col("node").alias("a"), F.col("grp").alias("ga")), groups.select(F.col("node").alias("b"), F.col("grp").alias("gb"))
    single = met.where("NOT crowded").select("a", "b").join(near[0], "a", "left").join(near[1], "b", "left")
    pairs = cut(single.where("ga IS NULL OR gb IS NULL OR ga <> gb").select("a", "b"))
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(groups.select("node")).distinct().join(nodes.select("node", "name"), "node")
    wanted = docs.select(_named(docs).alias("name"), text.alias("text"))
    held = stored(wanted.join(asked, "name").select("node", "name", "text"), "candidate-texts")
    texts = held.dropDuplicates(["node"])
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    whole = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    verified = cut(arrow_map(whole, "a binary, b binary", lambda batches: _verified(batches, threshold)))
    heavy = groups.join(texts.select("node", F.octet_length("text").alias("size")), "node")
    sizes = cut(heavy.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / BLOCK_BYTES), F.lit(1)).cast("int").alias("blocks")))
    dealt = groups.join(light(sizes), "grp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sides = texts.select("node", "text").join(dealt, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = sides.select("grp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "text")
    inside = cut(cells.groupBy("grp", "lo", "hi").applyInArrow(_block_pair(threshold), "node binary, root binary, n long"))
    discard(held)
    each = verified.select(F.col("a").alias("node"), F.lit(1).alias("n")).union(verified.select("b", F.lit(1))).union(inside.select("node", "n"))
    joined = verified.union(inside.where("node <> root").select("node", "root").distinct())
    return found, joined, each.groupBy("node").agg(F.sum("n").alias("n_links"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, **options) -> DataFrame:
    """doc_id, name, class_id (smallest name in the class, of rows with an id if there are any) and n_links of each row."""
    found, joined, counts = links(docs, threshold, recall, **options)
    roots = components(joined)
    best = found.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "name")).alias("best"))
    placed = best.join(roots, "node", "left").join(counts, "node", "left").select("node", "best", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    placed = cut(placed)
    tops = placed.groupBy("root").agg(F.min("best").alias("top"))
    known = placed.join(tops, "root").select("node", "n_links", F.col("top.name").alias("class_id"))
    return found.join(known, "node", "left").select("doc_id", "name", F.coalesce("class_id", "name").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of ``docs`` for each class: the one that gives the class its id."""
    kept = classes(docs, threshold, recall).where("name = class_id").select("name").distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _named(docs).alias("name"))
    return rows.join(kept, "name").dropDuplicates(["name"]).select("row.*")


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "n_links")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)

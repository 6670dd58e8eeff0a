"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree. DataFrame operations only.

* Targets: sources in code-point order, null last, get the weights in turn and share ``share`` times all words; a target stops at
  ``cap`` times its source's words and the excess is shared anew (the common level is found in closed form).
* Blocks: a hash deals each source's documents to ``blocks`` blocks. Blocks are drawn in a permuted order, once or twice over
  (passes), until the target is met; the block that straddles it is drawn in part, each of its documents by the same share.
* Tree: a source's quota is its number of drawn blocks. The quotas of all sources are split between the two halves of the output
  shards by a multivariate hypergeometric draw, exactly half of the blocks to each side, and so on down to single shards. Shards
  then take disjoint runs of each source's permuted blocks, and a hash orders the documents within a shard.

Only counts by source and block are aggregated, so a source that holds most rows is no hot key. The plan has one row a source with
a map of at most ``2 * blocks`` entries; it is broadcast if it holds at most ``PLAN_ENTRIES`` of them, so that rows stay where they
were read, else joined by a shuffle. Targets and the splitting tree hold all sources in one row: fine for some hundred thousand sources.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its own; repeated rows fall into the
same block and are treated alike; a null id takes part by its text; extra columns, whatever their names, pass through ``mix``
and do not matter elsewhere; an empty table gives an empty result. Draws depend on a seed and hashes only, so reruns agree.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import cut, light

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2.0
BLOCKS, DEPTH, SEED = 128, 4, 20240117
PLAN_ENTRIES = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def _uniform(*parts) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / F.lit(float(1 << 53))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size to the same with idx (place in code-point order) and target. One row a source, so one task."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    s = sources.select("source", "source_size", (place - 1).alias("idx"))
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod("idx", F.lit(len(weights))).cast("int") + 1).cast("double"))
    s = s.withColumns({"most": cap * F.col("source_size"), "level": cap * F.col("source_size") / F.col("w")})
    before, whole = W.orderBy("level", "idx").rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    s = s.withColumns({"full": F.coalesce(F.sum("most").over(before), F.lit(0.0)), "rest": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)), "all": share * F.sum("source_size").over(whole)})
    # the first source, by level, that need not be capped sets the level of all that follow
    fits = F.col("full") + F.col("level") * F.col("rest") >= F.col("all")
    s = s.withColumn("at", F.min(F.when(fits, F.struct("level", "idx", ((F.col("all") - F.col("full")) / F.col("rest")).alias("common")))).over(whole))
    return s.select("source", "source_size", "idx", F.least("most", F.coalesce(F.col("at.common"), F.col("level")) * F.col("w")).alias("target"))


def split_tree(quotas: DataFrame, depth: int = DEPTH) -> DataFrame:
    """idx, quota to (idx, shard, n): how many of a source's drawn blocks each of 2**depth shards takes."""
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("idx", "quota"))).alias("q")).select(F.lit(1).cast("long").alias("node"), F.col("q.idx").alias("ids"), F.transform("q.quota", lambda x: x.cast("long")).alias("counts")).where(F.size("ids") > 0)
    for _ in range(depth):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
        start = F.struct(total.alias("left"), F.floor(total / 2).alias("need"), F.array().cast("array<long>").alias("out"))

        def draw_one(state, k):
            # selection sampling of the k blocks of one source: a block goes left with probability need / left
            one = lambda s, i: F.struct((s["left"] - 1).alias("left"), F.when(_uniform(F.col("node"), s["left"], i) * s["left"] < s["need"], s["need"] - 1).otherwise(s["need"]).alias("need"))
            blocks = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
            now = F.aggregate(blocks, F.struct(state["left"].alias("left"), state["need"].alias("need")), one)
            return F.struct(now["left"].alias("left"), now["need"].alias("need"), F.concat(state["out"], F.array(state["need"] - now["need"])).alias("out"))

        halves = nodes.withColumn("go", F.aggregate("counts", start, draw_one)["out"])
        child = lambda node, counts: F.struct(node.alias("node"), counts.alias("counts"))
        nodes = halves.select("ids", F.explode(F.array(child(F.col("node") * 2, F.col("go")), child(F.col("node") * 2 + 1, F.zip_with("counts", "go", lambda a, b: a - b)))).alias("c")).select("c.node", "ids", "c.counts")
    return nodes.select((F.col("node") - (1 << depth)).cast("int").alias("shard"), F.explode(F.arrays_zip("ids", "counts")).alias("x")).select(F.col("x.ids").alias("idx"), "shard", F.col("x.counts").alias("n"))


def plan(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, depth: int = DEPTH) -> DataFrame:
    """From source, block and size of each document: source, source_size, target and draws, a map from 2 * block + pass to
    the share of the block that is taken and its output shard."""
    stats = cut(rows.groupBy("source", "block").agg(F.sum("size").alias("words")))
    goals = cut(targets(stats.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap))
    passes = -(-cap // 1)
    units = stats.where("words > 0").withColumn("pass", F.explode(F.array(*map(F.lit, range(int(passes))))))
    known = goals.withColumnRenamed("source", "known")
    units = units.join(known, F.col("source").eqNullSafe(F.col("known"))).select("idx", "block", "pass", "words", "target")
    order = W.partitionBy("idx").orderBy("pass", F.xxhash64(F.lit(SEED), "idx", "pass", "block"), "block")
    done = F.coalesce(F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    units = units.withColumns({"part": F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.round("target") - done) / F.col("words"))), "rank": F.row_number().over(order)}).where("part > 0")
    units = cut(units)
    tree = split_tree(units.groupBy("idx").agg(F.count("*").alias("quota")), depth)
    runs = tree.groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("runs"))
    ends = F.aggregate("runs", F.array().cast("array<long>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + x["n"])))
    runs = runs.select("idx", ends.alias("ends"))
    placed = units.join(runs, "idx").select("idx", (F.col("block") * 2 + F.col("pass")).alias("unit"), "part", F.size(F.filter("ends", lambda e: e < F.col("rank"))).alias("shard"))
    draws = placed.groupBy("idx").agg(F.map_from_entries(F.collect_list(F.struct("unit", F.struct("part", "shard")))).alias("draws"))
    return cut(goals.join(draws, "idx", "left").select("source", "source_size", "target", "draws"))


def _drawn(size: Column, which: int, key: Column) -> Column:
    """Words and shard of one pass over a document."""
    d = F.try_element_at("__draws", F.col("__block") * 2 + which)
    part = F.coalesce(d["part"], F.lit(0.0))
    words = F.when(part >= 1, size).otherwise(F.least(size, F.floor(size * part + _uniform(F.lit(which + 7), key)))).cast("long")
    return F.struct(F.lit(which).alias("pass"), words.alias("words"), d["shard"].alias("shard"))


def draw(docs: DataFrame, keep: list[Column], weights=WEIGHTS, share: float = SHARE, cap: float = CAP, blocks: int = BLOCKS, depth: int = DEPTH) -> DataFrame:
    """Columns ``keep`` with size, source_size, target, taken and drawn, an array of (pass, words, shard)."""
    key = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))
    rows = docs.select(*keep, F.col("source").cast("string").alias("__source"), n_words(F.col("text")).alias("__size"), key.alias("__key"), F.pmod(key, F.lit(blocks)).cast("int").alias("__block"))
    goals = plan(rows.select(F.col("__source").alias("source"), F.col("__block").alias("block"), F.col("__size").alias("size")), weights, share, cap, depth)
    entries = F.coalesce(F.size("__draws"), F.lit(0)) + 1
    goals = goals.select(*(F.col(c).alias(f"__{c}") for c in ("source_size", "target", "draws")), F.col("source").alias("__known"))
    joined = rows.join(light(goals, PLAN_ENTRIES, entries), F.col("__source").eqNullSafe(F.col("__known")), "left")
    drawn = F.filter(F.array(*(_drawn(F.col("__size"), i, F.col("__key")) for i in range(int(-(-cap // 1))))), lambda d: d["words"] > 0)
    out = joined.withColumn("__drawn", drawn)
    taken = F.aggregate("__drawn", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    names = [c for c in rows.columns if c not in ("__source", "__size", "__key", "__block")]
    return out.select(*(F.col(f"`{c}`") for c in names), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), taken.alias("taken"), F.col("__drawn").alias("drawn"), "__key")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: a row of all columns of ``docs`` for each time a document is drawn (whole, also where the quota ends
    within it), ordered by shard and, within it, shuffled."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), "doc_id", "text", "source")
    rows = draw(packed, [F.col("__row")], **options).select("__row", "__key", F.explode("drawn").alias("d"))
    order = F.xxhash64(F.lit(SEED), F.col("d.shard"), F.col("d.pass"), F.col("__key")).alias("__order")
    placed = rows.select("__row", F.col("d.shard").alias("__shard"), order)
    return placed.repartitionByRange("__shard", "__order").sortWithinPartitions("__shard", "__order").select("__row.*")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return draw(docs, [F.col("doc_id").cast("long").alias("doc_id")]).select("doc_id", "size", "source_size", "target", "taken", F.transform("drawn", lambda d: d["shard"]).alias("shards"))

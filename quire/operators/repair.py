"""Repairs of a slice's blocks, in a fixed order; each leaves its name in ``repair_actions``.

Rows are blocks: key, page, rn (order in the slice), block_type, markdown, node_ref, is_overlap, repaired, repair_actions. A pass
returns the same rows, with an emptied Markdown where a block went into another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.session import cut

PRIORITY = {"heading": 0, "paragraph": 1, "list_item": 2, "code": 3, "table": 4, "image": 5}


def priority(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv)), kind), F.lit(99))


def ordered(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """rn by page, reading order, type and the order given (ordinal)."""
    w = W.partitionBy(key).orderBy("page", "reading_order", priority(F.col("block_type")), "ordinal")
    rows = blocks.withColumn("rn", F.row_number().over(w))
    new = {c: v for c, v in {"repaired": F.lit(False), "repair_actions": F.array().cast("array<string>")}.items() if c not in rows.columns}
    return rows.withColumns(new) if new else rows


def _fixed(df: DataFrame, when: Column, action: str, **changes: Column) -> DataFrame:
    hit = F.coalesce(when, F.lit(False))
    df = df.withColumn("__hit", hit)
    hit = F.col("__hit")
    return df.withColumns({**{c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()}, "repaired": F.col("repaired") | hit, "repair_actions": F.when(hit, F.concat("repair_actions", F.array(F.lit(action)))).otherwise(F.col("repair_actions"))}).drop("__hit")


def fenced_texts(drafts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Texts within the fences of drafts (key, markdown); an open fence runs to the end. Parity of fence lines tells inside."""
    w = W.partitionBy(key).orderBy("at")
    lines = drafts.select(key, F.posexplode(F.split("markdown", "\n")).alias("at", "line")).withColumn("fence", T.strip(F.col("line")).startswith("```"))
    lines = lines.withColumn("n", F.sum(F.col("fence").cast("int")).over(w)).where("NOT fence AND n % 2 = 1")
    return lines.groupBy(key, "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("code"))


def recover_code(blocks: DataFrame, drafts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Paragraphs of at least 8 characters that stand within a fence of the draft are code."""
    codes = fenced_texts(drafts, key).groupBy(key).agg(F.collect_list(T.squeeze(F.col("code"))).alias("codes"))
    norm = T.squeeze(F.col("markdown"))
    hit = (F.col("block_type") == "paragraph") & (F.length(norm) >= 8) & F.exists("codes", lambda c: F.contains(c, norm))
    return _fixed(blocks.join(codes, key, "left"), hit, "code_block_rebuilt", block_type=F.lit("code"), markdown=F.concat(F.lit("```\n"), "markdown", F.lit("\n```"))).drop("codes")


def code_islands(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Runs of at least three code-like paragraphs of a page: key, page, first_rn, n."""
    rows = _code_runs(blocks, key).where("code")
    return rows.groupBy(key, "page", "run").agg(F.min("rn").alias("first_rn"), F.count("*").alias("n")).where("n >= 3").drop("run")


def _code_runs(blocks: DataFrame, key: str) -> DataFrame:
    w = W.partitionBy(key, "page").orderBy("rn")
    rows = blocks.withColumn("code", F.coalesce((F.col("block_type") == "paragraph") & T.is_code_like(F.col("markdown")), F.lit(False)))
    return rows.withColumn("run", F.sum(F.when(F.col("code") & F.coalesce(F.lag("code").over(w), F.lit(False)), 0).otherwise(1)).over(w))


def merge_code(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Such runs become one fence in their first block. The texts of a run are gathered once and joined to that block."""
    rows = _code_runs(blocks, key).withColumn("k", F.row_number().over(W.partitionBy(key, "page", "run").orderBy("rn")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "markdown"))), lambda x: x["markdown"]), "\n")
    bodies = rows.where("code").groupBy(key, "page", "run").agg(F.count("*").alias("n"), body.alias("body")).where("n >= 3").drop("n").withColumn("island", F.lit(True))
    heads = bodies.withColumn("k", F.lit(1)).drop("island")
    rows = rows.join(bodies.select(key, "page", "run", "island"), [key, "page", "run"], "left").join(heads, [key, "page", "run", "k"], "left")
    rows = rows.withColumn("island", F.coalesce("island", F.lit(False)))
    rows = _fixed(rows, F.col("body").isNotNull(), "code_block_rebuilt", block_type=F.lit("code"), markdown=F.concat(F.lit("```\n"), F.col("body"), F.lit("\n```")))
    return rows.withColumn("markdown", F.when(F.col("island") & (F.col("k") > 1), "").otherwise(F.col("markdown"))).select(*blocks.columns)


def top_heading(blocks: DataFrame, titles: DataFrame, key: str = "doc_id") -> DataFrame:
    """A slice without a first-level heading gets one: the first heading that reads like its title, else a new block before the
    first page that is no overlap; titles: key, display_title."""
    head = F.col("block_type") == "heading"
    bare = F.regexp_replace("markdown", r"^#{1,6}\s+", "")
    rows = blocks.join(titles, key, "left").withColumns({"h1": head & F.col("markdown").startswith("# "), "like": head & (T.squeeze(bare) == T.squeeze(F.col("display_title")))})
    w = W.partitionBy(key)
    rows = rows.withColumns({"has": F.max("h1").over(w), "promoted": F.min(F.when(F.col("like"), F.col("rn"))).over(w), "target": F.coalesce(F.min(F.when(~F.col("is_overlap"), F.col("page"))).over(w), F.min("page").over(w))})
    titled = ~F.coalesce("has", F.lit(False)) & (F.coalesce("display_title", F.lit("")) != "")
    new = rows.where(titled & F.col("promoted").isNull() & (F.col("page") == F.col("target"))).groupBy(key).agg(F.first("target").alias("page"), F.min("rn").alias("rn"), F.min("reading_order").alias("reading_order"), F.first("display_title").alias("t"))
    fresh = new.select(key, "page", (F.col("rn") - 0.5).alias("rn"), (F.col("reading_order") - 1).alias("reading_order"), F.lit("heading").alias("block_type"), F.concat(F.lit("# "), "t").alias("markdown"), F.lit(None).cast("string").alias("node_ref"), F.lit(False).alias("is_overlap"), F.lit(True).alias("repaired"), F.array(F.lit("heading_inserted")).alias("repair_actions"))
    kept = _fixed(rows, titled & (F.col("rn") == F.col("promoted")), "heading_inserted", markdown=F.concat(F.lit("# "), bare)).select(*blocks.columns)
    out = kept.withColumn("rn", F.col("rn").cast("double")).unionByName(fresh, allowMissingColumns=True)
    return out.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy("rn")))


def restored(blocks: DataFrame, missing: DataFrame, key: str = "doc_id") -> DataFrame:
    """The first block of each missing reference is marked: texts and images are rebuilt from the content anyway. missing: key,
    node_ref, issue_type, and page for lost overlap pages."""
    refs = missing.where(F.col("issue_type").isin("missing_block", "image_reference_missing")).select(key, "node_ref", "issue_type").distinct()
    rows = blocks.join(refs, [key, "node_ref"], "left")
    first = F.row_number().over(W.partitionBy(key, "node_ref").orderBy("rn")) == 1
    rows = rows.withColumn("first", first & (F.col("markdown") != ""))
    rows = _fixed(rows, F.col("first") & (F.col("issue_type") == "missing_block"), "missing_block_restored")
    rows = _fixed(rows, F.col("first") & (F.col("issue_type") == "image_reference_missing") & ~F.contains("markdown", F.lit("<!--")), "image_reference_restored").drop("first", "issue_type")
    if "page" in missing.columns:
        lost = missing.where("issue_type = 'overlap_lost'").select(key, "page").distinct().withColumn("lost", F.lit(True))
        rows = _fixed(rows.join(lost, [key, "page"], "left"), F.col("lost") & (F.col("markdown") != ""), "overlap_block_restored").drop("lost")
    return rows.select(*blocks.columns)


def structure(blocks: DataFrame, captions: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """Open fences closed, list marks and table separators put back, default image texts filled from captions (key, node_ref,
    caption)."""
    md, kind = F.col("markdown"), F.col("block_type")
    rows = _fixed(blocks, (kind == "code") & (md != "") & (T.fences(md) % 2 == 1), "code_fence_closed", markdown=F.concat(F.rtrim(md), F.lit("\n```")))
    rows = _fixed(rows, (kind == "list_item") & (md != "") & ~md.rlike(r"^(?:[-*] |\d+\.\s)"), "list_rebuilt", markdown=F.concat(F.lit("- "), md))
    rows = _fixed(rows, (kind == "table") & (T.with_separator(md) != md), "table_separator_inserted", markdown=T.with_separator(md))
    if captions is not None:
        named = rows.join(captions.where("caption <> ''").select(key, "node_ref", "caption"), [key, "node_ref"], "left")
        at = F.instr(md, "![image](")
        filled = F.concat(F.left(md, at - 1), F.lit("!["), F.col("caption"), F.lit("]("), F.substring(md, at + 9, F.length(md)))
        rows = _fixed(named, (kind == "image") & F.col("caption").isNotNull() & (at > 0), "image_caption_filled", markdown=filled).select(*blocks.columns)
    return rows


def clamped_levels(levels: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, rn, level with clamped: no heading is more than one level below the one before it, as corrected. In closed form, the
    least of (level - rn) so far, plus rn, over consecutive numbers."""
    w = W.partitionBy(key).orderBy("rn")
    n = F.row_number().over(w)
    numbered = levels.withColumn("__n", n)
    run = W.partitionBy(key).orderBy("__n").rowsBetween(W.unboundedPreceding, 0)
    return numbered.withColumn("clamped", (F.col("__n") + F.min(F.col("level") - F.col("__n")).over(run)).cast("int")).drop("__n")


def heading_levels(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    mark = F.length(F.regexp_extract("markdown", r"^(#{1,6})\s", 1))
    heads = blocks.where((F.col("block_type") == "heading") & (mark > 0)).select(key, "rn", mark.alias("level"))
    rows = blocks.join(clamped_levels(heads, key), [key, "rn"], "left")
    fixed = F.concat(F.repeat(F.lit("#"), F.col("clamped")), F.regexp_replace("markdown", "^#{1,6}", ""))
    return _fixed(rows, F.col("clamped") < F.col("level"), "heading_normalized", markdown=fixed).select(*blocks.columns)


def paragraph_heads(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, page, rn of paragraphs that the next one continues. A block that went into another can't take one in, so of a chain of
    such edges every other one holds, from the first."""
    w = W.partitionBy(key, "page").orderBy("rn")
    good = lambda c, k: (k == "paragraph") & (F.coalesce(c, F.lit("")) != "")
    nxt, kind = F.lead("markdown").over(w), F.lead("block_type").over(w)
    edge = good(F.col("markdown"), F.col("block_type")) & good(nxt, kind) & ~T.ends_sentence(F.col("markdown")) & T.goes_on(nxt)
    rows = blocks.withColumn("edge", F.coalesce(edge, F.lit(False)))
    rows = rows.withColumn("run", F.sum(F.when(F.col("edge") & F.coalesce(F.lag("edge").over(w), F.lit(False)), 0).otherwise(1)).over(w))
    rank = F.row_number().over(W.partitionBy(key, "page", "run").orderBy("rn"))
    return rows.withColumn("rank", rank).where("edge AND rank % 2 = 1").select(key, "page", "rn")


def join_paragraphs(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    heads = paragraph_heads(blocks, key).select(key, "rn").withColumn("head", F.lit(True))
    w = W.partitionBy(key, "page").orderBy("rn")
    rows = blocks.join(heads, [key, "rn"], "left").withColumns({"nxt": F.lead("markdown").over(w), "tail": F.coalesce(F.lag("head").over(w), F.lit(False))})
    rows = _fixed(rows, F.col("head"), "paragraph_merged", markdown=F.concat(F.rtrim("markdown"), F.lit(" "), F.ltrim("nxt")))
    return rows.withColumn("markdown", F.when(F.col("tail"), "").otherwise(F.col("markdown"))).select(*blocks.columns)


def repair(blocks: DataFrame, drafts: DataFrame, titles: DataFrame, missing: DataFrame, captions: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """All passes in their order: code, completeness, structure, style. The plan is cut between the groups, since each pass reads
    its predecessor's columns more than once."""
    rows = cut(merge_code(recover_code(blocks, drafts, key), key))
    rows = cut(restored(top_heading(rows, titles, key), missing, key))
    rows = cut(structure(rows, captions, key))
    return join_paragraphs(cut(heading_levels(rows, key)), key)


def fixes(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row a repair: key, page, node_ref, fix_type."""
    return blocks.select(key, "page", "node_ref", F.explode("repair_actions").alias("fix_type"))


def render(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Markdown of each slice and counts of what is in it."""
    shown = blocks.where(F.coalesce("markdown", F.lit("")) != "")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "markdown"))), lambda x: x["markdown"]), "\n\n")
    return shown.groupBy(key).agg(body.alias("markdown"), F.count_if(~F.col("block_type").isin("table", "image")).alias("text_blocks"), F.count_if(F.col("block_type") == "table").alias("tables"), F.count_if(F.col("block_type") == "image").alias("images")).withColumn("char_count", F.length("markdown"))

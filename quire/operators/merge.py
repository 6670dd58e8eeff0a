"""Merging neighbouring slices: what they share is found at their boundary and kept once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T

WINDOW, DUPLICATES, DRIFT = 20, 3, 0.2


def boundary_blocks(blocks: DataFrame, doc: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """The first and last blocks of each slice (doc, slice, ordinal, ...): side head or tail; a short slice's blocks are both."""
    head = F.row_number().over(W.partitionBy(doc, "slice").orderBy("ordinal"))
    tail = F.row_number().over(W.partitionBy(doc, "slice").orderBy(F.desc("ordinal")))
    first = blocks.withColumn("k", head).where(F.col("k") <= window).drop("k").withColumn("side", F.lit("head"))
    return first.unionByName(blocks.withColumn("k", tail).where(F.col("k") <= window).drop("k").withColumn("side", F.lit("tail")))


def overlap_matches(blocks: DataFrame, doc: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Blocks at the head of a slice that stand in the tail of the one before it: doc, right, ordinal, strategy. Three equi joins by
    falling priority: key; page, type and text; asset. Columns that may lack are dedupe_key, source_page, block_type,
    text_hash, asset_ref. Headings that open a chapter (protected) match nothing."""
    sides = boundary_blocks(blocks, doc, window)
    tail = sides.where("side = 'tail'").withColumn("right", F.col("slice") + 1)
    head = sides.where("side = 'head'").withColumn("right", F.col("slice"))
    if "protected" in blocks.columns:
        head = head.where("NOT protected")
    found = None
    for rank, (name, on) in enumerate((("dedupe_key", ["dedupe_key"]), ("source_page_text_hash", ["source_page", "block_type", "text_hash"]), ("asset_ref", ["asset_ref"]))):
        if not set(on) <= set(blocks.columns):
            continue
        full = " AND ".join(f"{c} IS NOT NULL AND cast({c} AS string) <> ''" for c in on)
        left = tail.where(full).groupBy(doc, "right", *on).agg(F.min("ordinal").alias("left_at"))
        hits = head.where(full).join(left, [doc, "right", *on]).select(doc, "right", "ordinal", F.struct("left_at", F.lit(rank).alias("rank"), F.lit(name).alias("strategy")).alias("m"))
        found = hits if found is None else found.unionByName(hits)
    # of all matches that of the first block of the tail counts, and there the first rule
    return found.groupBy(doc, "right", "ordinal").agg(F.min("m").alias("m")).select(doc, "right", "ordinal", F.col("m.strategy").alias("strategy"))


def match_runs(blocks: DataFrame, doc: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """The matched blocks that are removed, doc, right, ordinal, strategy: the first run of matches at a slice's head. Blocks before
    the first match are passed over."""
    head = boundary_blocks(blocks, doc, window).where("side = 'head' AND slice > 1").select(doc, F.col("slice").alias("right"), "ordinal")
    rows = head.join(overlap_matches(blocks, doc, window), [doc, "right", "ordinal"], "left")
    w = W.partitionBy(doc, "right")
    rows = rows.withColumn("first", F.min(F.when(F.col("strategy").isNotNull(), F.col("ordinal"))).over(w))
    rows = rows.withColumn("stop", F.min(F.when(F.col("strategy").isNull() & (F.col("ordinal") > F.col("first")), F.col("ordinal"))).over(w))
    return rows.where("strategy IS NOT NULL AND (stop IS NULL OR ordinal < stop)").select(doc, "right", "ordinal", "strategy")


def decisions(blocks: DataFrame, doc: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row for each pair of slices with what was removed: strategy and page are those of the last match."""
    runs = match_runs(blocks, doc, window)
    with_page = runs.join(blocks.select(doc, F.col("slice").alias("right"), "ordinal", "source_page"), [doc, "right", "ordinal"])
    return with_page.groupBy(doc, "right").agg(F.min("ordinal").alias("first_removed"), F.count("*").alias("removed_count"), F.max_by("strategy", "ordinal").alias("strategy"), F.max_by("source_page", "ordinal").alias("source_page"))


def deduplicated(blocks: DataFrame, doc: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Blocks without those that the slice before them already has."""
    gone = match_runs(blocks, doc, window).select(doc, F.col("right").alias("slice"), "ordinal")
    return blocks.join(gone, [doc, "slice", "ordinal"], "left_anti")


def unstable(blocks: DataFrame, doc: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Pairs that are marked as overlapping and have no match."""
    sides = boundary_blocks(blocks, doc, window).withColumn("right", F.when(F.col("side") == "tail", F.col("slice") + 1).otherwise(F.col("slice")))
    both = sides.groupBy(doc, "right").agg(F.max("is_overlap").alias("marked"), F.count_distinct("side").alias("sides")).where("marked AND sides = 2")
    return both.select(doc, "right").join(match_runs(blocks, doc, window).select(doc, "right").distinct(), [doc, "right"], "left_anti").withColumn("warning_type", F.lit("overlap_match_unstable"))


def page_gaps(slices: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Neighbouring slices (doc, slice, start_page, end_page) with pages missing between them."""
    w = W.partitionBy(doc).orderBy("slice")
    rows = slices.withColumns({"left": F.lag("slice").over(w), "before": F.lag("end_page").over(w)})
    return rows.where("before + 1 < start_page").select(doc, "left", F.col("slice").alias("right"), (F.col("start_page") - F.col("before") - 1).alias("gap"))


def repeats(blocks: DataFrame, doc: str = "doc_id", least: int = DUPLICATES) -> DataFrame:
    """Runs of at least ``least`` equal neighbours (doc, rn, hash): doc, first_rn, n."""
    w = W.partitionBy(doc).orderBy("rn")
    run = F.sum(F.when(F.col("hash") == F.lag("hash").over(w), 0).otherwise(1)).over(w)
    return blocks.withColumn("run", run).groupBy(doc, "run").agg(F.min("rn").alias("first_rn"), F.count("*").alias("n")).where(F.col("n") >= least).drop("run")


def stitched(parts: DataFrame, key: str, order: str, column: str = "markdown", separator: str = "\n\n") -> DataFrame:
    """Parts stripped, empty ones left out, joined in order, with a line end: key, markdown, char_count. A thematic break is the
    separator "\\n\\n---\\n\\n"."""
    kept = parts.withColumn("__part", T.strip(F.coalesce(column, F.lit("")))).where("__part <> ''")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "__part"))), lambda x: x["__part"]), separator)
    return kept.groupBy(key).agg(F.concat(joined, F.lit("\n")).alias("markdown")).withColumn("char_count", F.length("markdown"))


def relinked(slices: DataFrame) -> DataFrame:
    """Asset paths of slices (order_index, display_title, markdown) moved below a folder for the slice: the rows with the new
    Markdown and relinks, an array of (original, rewritten)."""
    folder = F.concat(F.format_string("%03d-", "order_index"), T.safe_name(F.col("display_title")))
    rows = slices.withColumn("folder", folder)
    safe = F.regexp_replace("folder", r"([\\$])", r"\\$1")
    md = F.regexp_replace(F.col("markdown"), F.lit(r"(!\[[^\]]*\])\(assets/([^)]+)\)"), F.concat(F.lit("$1(assets/"), safe, F.lit("/$2)")))
    md = F.regexp_replace(md, F.lit(r"""(src=["'])assets/([^"']+)"""), F.concat(F.lit("$1assets/"), safe, F.lit("/$2")))
    paths = F.concat(F.regexp_extract_all("markdown", F.lit(r"!\[[^\]]*\]\(assets/([^)]+)\)"), 1), F.regexp_extract_all("markdown", F.lit(r"""src=["']assets/([^"']+)"""), 1))
    links = F.transform(paths, lambda p: F.struct(F.concat(F.lit("assets/"), p).alias("original"), F.concat(F.lit("assets/"), F.col("folder"), F.lit("/"), p).alias("rewritten")))
    return rows.withColumns({"markdown": md, "relinks": links}).drop("folder")


def relinked_to_source(slices: DataFrame) -> DataFrame:
    """Asset paths of slices (order_index, display_title, markdown) that stay where the phase before wrote them: they lead out of the
    slice's folder to that of the source."""
    folder = F.concat(F.format_string("%03d-", "order_index"), T.safe_name(F.col("display_title")))
    rows = slices.withColumn("folder", folder)
    there = F.concat(F.lit("../"), F.regexp_replace("folder", r"([\\$])", r"\\$1"), F.lit("/assets/"))
    md = F.regexp_replace(F.col("markdown"), F.lit(r"(!\[[^\]]*\]\()assets/([^)]+)"), F.concat(F.lit("$1"), there, F.lit("$2")))
    return rows.withColumn("markdown", F.regexp_replace(md, F.lit(r"""(src=["'])assets/([^"']+)"""), F.concat(F.lit("$1"), there, F.lit("$2"))))


def opens_chapter(block_type, source_page, start_page, markdown):
    """Whether a block is a heading of the first or second level on its slice's first page."""
    return F.coalesce((block_type == "heading") & (source_page == start_page) & T.strip(markdown).rlike("^#{1,2} "), F.lit(False))


def summary(books: DataFrame, decisions: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row for a run: books, decisions, removed blocks, warnings, and failed if any slice is missing."""
    gone = decisions.agg(F.count("*").alias("decisions"), F.coalesce(F.sum("removed_count"), F.lit(0)).alias("removed_blocks"))
    told = warnings.agg(F.count("*").alias("warnings"), F.coalesce(F.max(F.col("warning_type") == "slice_missing"), F.lit(False)).alias("lost"))
    one = books.agg(F.count("*").alias("books")).withColumn("k", F.lit(1))
    rows = one.join(gone.withColumn("k", F.lit(1)), "k").join(told.withColumn("k", F.lit(1)), "k")
    return rows.select("books", "decisions", "removed_blocks", "warnings", F.when(F.col("lost"), "failed").otherwise("success").alias("status"))


def image_references(markdown):
    """Distinct sources of Markdown and HTML images."""
    return F.array_distinct(F.concat(F.regexp_extract_all(markdown, F.lit(r"!\[[^\]]*\]\(([^)]+)\)"), 1), F.regexp_extract_all(markdown, F.lit(r"""(?i)<img\s[^>]*src=["']([^"']+)["']"""), 1)))


def equal_neighbours(books: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Warnings about merged Markdown (doc, markdown) in which a paragraph follows itself too often."""
    parts = books.select(doc, F.posexplode(F.filter(F.transform(F.split("markdown", "\n\n+"), T.strip), lambda p: p != "")).alias("rn", "part"))
    return repeats(parts.select(doc, "rn", T.text_hash(T.squeeze(F.col("part"))).alias("hash")), doc).select(doc, F.lit("consecutive_duplicate_detected").alias("warning_type")).distinct()


def merged_checks(books: DataFrame, assets: DataFrame | None = None, doc: str = "doc_id") -> DataFrame:
    """Warnings about merged Markdown (doc, markdown, n_slices): empty, first-level headings far from the number of slices, assets
    (doc, path) that aren't there, equal neighbours."""
    text = F.coalesce("markdown", F.lit(""))
    empty = books.where(T.strip(text) == "").select(doc, F.lit("slice_missing").alias("warning_type"))
    full = books.where(T.strip(text) != "")
    h1 = F.regexp_count(F.col("markdown"), F.lit(r"(?m)^#[ \t]+.+$"))
    heads = full.where((h1 > 0) & (F.abs(h1 - F.col("n_slices")) > F.col("n_slices") * 0.5)).select(doc, F.lit("heading_count_mismatch").alias("warning_type"))
    out = empty.union(heads).union(equal_neighbours(full, doc))
    if assets is not None:
        refs = full.select(doc, F.explode(image_references(F.col("markdown"))).alias("path")).where(F.col("path").startswith("assets/"))
        out = out.union(refs.join(assets, [doc, "path"], "left_anti").select(doc, F.lit("asset_path_missing").alias("warning_type")))
    return out


def format_checks(texts: DataFrame, key: str = "doc_id", drift: float = DRIFT) -> DataFrame:
    """Issues of normalised Markdown: rows key, before and after (segments counted), markdown, asset_paths."""
    none = T.strip(F.coalesce("markdown", F.lit(""))) == ""
    moved = ~none & (F.col("before") > 0) & (F.abs(F.col("after") - F.col("before")) > F.col("before") * drift)
    lost = F.when(~none, F.filter(F.coalesce("asset_paths", F.array().cast("array<string>")), lambda p: (p != "") & ~F.contains("markdown", p)))
    unstable_ = texts.where(none | F.coalesce(moved, F.lit(False))).select(key, F.lit("format_parse_unstable").alias("issue_type"), F.lit("error").alias("severity"))
    return unstable_.unionByName(texts.select(key, F.explode(lost).alias("p")).select(key, F.lit("asset_not_found").alias("issue_type"), F.lit("warning").alias("severity")))

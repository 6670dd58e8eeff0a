"""The four phases over many documents at once, composed of the operators. Each returns tables; sources and sinks are apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import markdown as M
from quire.functions import text as T
from quire.operators import align, blocks, chapters, merge, planner, repair, tables
from quire.session import cut


def slice_phase(toc: DataFrame, layout: DataFrame, texts: DataFrame, target: int = planner.TARGET) -> DataFrame:
    """Slices of laid-out documents; texts: doc_id, page, text."""
    pages = layout.groupBy("doc_id").agg(F.max("page").alias("total_pages"))
    pages = cut(pages)
    found = cut(chapters.recognize(toc, layout, pages))
    inner = cut(chapters.sections(found, toc, layout)).groupBy("doc_id", "chapter").agg(F.array_sort(F.collect_list(F.struct("start_page", "end_page", "title", "level"))).alias("s"))
    inner = inner.select("doc_id", F.col("chapter").alias("pos"), F.transform("s", lambda x: F.struct(x["title"].alias("title"), x["start_page"].alias("start_page"), x["end_page"].alias("end_page"), x["level"].alias("level"))).alias("sections"))
    nested = found.join(inner, ["doc_id", "pos"], "left").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "title", "start_page", "end_page", "level", "sections"))).alias("c"))
    nested = nested.select("doc_id", F.transform("c", lambda x: F.struct(x["title"].alias("title"), x["start_page"].alias("start_page"), x["end_page"].alias("end_page"), x["level"].alias("level"), x["sections"].alias("sections"))).alias("chapters"))
    safe = cut(blocks.boundaries(layout)).groupBy("doc_id").agg(F.collect_list(F.when(F.col("safe"), F.col("page"))).alias("safe"))
    words = texts.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("page", "text"))).alias("texts"))
    rows = nested.join(pages.withColumnRenamed("total_pages", "last_page"), "doc_id").join(safe, "doc_id").join(words, "doc_id", "left")
    return planner.slice_names(planner.plan(rows, target))


def exploded(content: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Blocks, tables, images and pages of extracted content, with references."""
    pages = content.select(F.col("slice_file").alias("doc_id"), F.explode("source_pages").alias("p"))
    b = pages.select("doc_id", F.col("p.source_page").alias("page"), F.col("p.is_overlap").alias("page_overlap"), F.posexplode("p.blocks").alias("at", "b"))
    b = b.select("doc_id", "page", F.col("b.type").alias("block_type"), F.col("b.text").alias("text"), F.col("b.reading_order").alias("reading_order"), (F.coalesce("b.is_overlap", F.lit(False)) | F.coalesce("page_overlap", F.lit(False))).alias("is_overlap"), F.col("b.dedupe_key").alias("dedupe_key"), F.col("b.heading_level").alias("heading_level"), "at")
    most = F.coalesce(F.array_max(F.transform("p.blocks", lambda x: x["reading_order"])), F.lit(0))

    def others(kind, after):
        rows = pages.select("doc_id", F.col("p.source_page").alias("page"), F.coalesce("p.is_overlap", F.lit(False)).alias("is_overlap"), (most + after).alias("after"), F.posexplode(f"p.{kind}s").alias("at", "x"))
        place = F.coalesce(F.try_element_at("x.bbox", F.lit(2)).cast("int"), F.col("after"))
        return rows.select("doc_id", "page", "is_overlap", "at", F.concat_ws(":", F.lit(kind), "page", "at").alias("node_ref"), place.alias("reading_order"), "x.*")

    return b, others("table", F.lit(1)), others("image", F.coalesce(F.size("p.tables"), F.lit(0)) + 1), pages.select("doc_id", F.col("p.source_page").alias("page"), F.coalesce("p.is_overlap", F.lit(False)).alias("is_overlap"), F.col("p.markdown").alias("markdown"))


def draft_levels(drafts: DataFrame) -> DataFrame:
    """Levels of the headings of drafts by their text; of equal texts the last counts."""
    lines = drafts.select("doc_id", F.posexplode(F.split("markdown", "\n")).alias("at", "line")).withColumn("line", T.strip(F.col("line"))).where(F.col("line").rlike(r"^#{1,6}\s+.+"))
    heads = lines.select("doc_id", "at", F.length(F.regexp_extract("line", "^(#{1,6})", 1)).alias("draft_level"), T.normalized(F.regexp_replace("line", r"^#{1,6}\s+", "")).alias("norm"))
    return heads.groupBy("doc_id", "norm").agg(F.max_by("draft_level", "at").alias("draft_level"))


def format_phase(content: DataFrame, drafts: DataFrame, strict: bool = False) -> dict[str, DataFrame]:
    """Audit, repair and render slices: content as in schemas.CONTENT, drafts doc_id (the slice), markdown. Gives coverage, issues, fixes,
    blocks and documents (doc_id, markdown, passed, manual_review_required)."""
    b, t, i, pages = exploded(content)
    b = b.withColumn("norm", T.normalized(F.coalesce("text", F.lit(""))))
    parsed = M.segments(drafts, ["doc_id"])
    b, segments = cut(b), cut(parsed.withColumn("norm", T.normalized(F.coalesce("text", F.lit("")))))
    placed = b.withColumns({"ordinal": F.xxhash64("page", "at"), "source_page": F.col("page")})
    found = cut(align.align(placed, segments))
    ts, im = align.matched_tables(t, segments, strict=strict), align.matched_images(i, segments, drafts)
    lost = align.overlap_issues(pages.withColumnRenamed("page", "source_page"))
    problems = align.issues(found, ts, im).unionByName(lost.select("doc_id", "issue_type", "severity", F.col("source_page").cast("string").alias("node_ref"), F.lit("Overlap page has no text").alias("message"), F.lit(True).alias("auto_fixable")))
    problems = cut(problems)
    levels = b.join(draft_levels(drafts), ["doc_id", "norm"], "left").withColumn("level", F.coalesce(F.nullif("heading_level", F.lit(0)), "draft_level", T.heading_level(F.col("text"))))
    text_rows = levels.select("doc_id", "page", "reading_order", "block_type", T.block_markdown(F.col("block_type"), F.col("text"), F.col("level")).alias("markdown"), F.col("dedupe_key").alias("node_ref"), "is_overlap", F.col("at").alias("ordinal"))
    shown = tables.table_markdown(F.struct(*(F.col(c) for c in ("markdown", "headers", "rows", "fallback_html", "fallback_image"))))
    table_rows = t.withColumn("m", shown).select("doc_id", "page", "reading_order", F.lit("table").alias("block_type"), F.coalesce("m.markdown", F.concat(F.lit("<!-- table "), "node_ref", F.lit(": no content available -->"))).alias("markdown"), "node_ref", "is_overlap", (F.col("at") + 100_000).alias("ordinal"), F.col("m.fix").alias("fix"))
    image_rows = i.select("doc_id", "page", "reading_order", F.lit("image").alias("block_type"), F.when(F.coalesce("asset_path", F.lit("")) == "", F.concat(F.lit("<!-- image "), "node_ref", F.lit(": no asset path -->"))).otherwise(F.concat(F.lit("!["), F.coalesce(F.nullif("caption", F.lit("")), F.lit("image")), F.lit("]("), "asset_path", F.lit(")"))).alias("markdown"), "node_ref", "is_overlap", (F.col("at") + 200_000).alias("ordinal"))
    rows = cut(repair.ordered(text_rows.unionByName(table_rows.drop("fix")).unionByName(image_rows)))
    missing = problems.where("issue_type <> 'overlap_lost'").select("doc_id", "node_ref", "issue_type", F.lit(None).cast("int").alias("page")).unionByName(lost.select("doc_id", F.lit(None).cast("string").alias("node_ref"), "issue_type", F.col("source_page").cast("int").alias("page")))
    titles = content.select(F.col("slice_file").alias("doc_id"), "display_title")
    done = cut(repair.repair(rows, drafts, titles, missing, i.select("doc_id", "node_ref", "caption")))
    raw = repair.render(done)
    final = cut(raw.withColumn("final", M.normalize_markdown("markdown")))
    counts = lambda column, name: M.segments(final, ["doc_id"], column).groupBy("doc_id").agg(F.count("*").alias(name))
    assets = i.where("asset_path <> ''").groupBy("doc_id").agg(F.collect_set("asset_path").alias("asset_paths"))
    checked = final.join(counts("markdown", "before"), "doc_id", "left").join(counts("final", "after"), "doc_id", "left").join(assets, "doc_id", "left")
    checks = merge.format_checks(checked.select("doc_id", "before", F.coalesce("after", F.lit(0)).alias("after"), F.col("final").alias("markdown"), "asset_paths"))
    bad = checks.where("severity = 'error'").select("doc_id").distinct().withColumn("bad", F.lit(True))
    errors = problems.where("severity = 'error'").select("doc_id").distinct().withColumn("error", F.lit(True))
    docs = final.join(bad, "doc_id", "left").join(errors, "doc_id", "left").join(content.select(F.col("slice_file").alias("doc_id"), "display_title", "start_page", "end_page", F.col("manual_review_required").alias("before_review")), "doc_id")
    docs = docs.select("doc_id", "display_title", "start_page", "end_page", F.when(F.coalesce("bad", F.lit(False)), F.col("markdown")).otherwise(F.col("final")).alias("markdown"), (~F.coalesce("bad", F.lit(False))).alias("passed"), (F.coalesce("before_review", F.lit(False)) | F.coalesce("bad", F.lit(False)) | F.coalesce("error", F.lit(False))).alias("manual_review_required"))
    extra = table_rows.where("fix IS NOT NULL").select("doc_id", "page", "node_ref", F.col("fix").alias("fix_type"))
    return {"coverage": align.coverage(found), "issues": problems.unionByName(checks.select("doc_id", "issue_type", "severity", F.lit(None).cast("string").alias("node_ref"), F.lit("after normalisation").alias("message"), F.lit(False).alias("auto_fixable"))), "fixes": repair.fixes(done).unionByName(extra), "blocks": done, "documents": docs}


def merge_phase(slices: DataFrame, refs: DataFrame | None = None, separator: str = "\n\n") -> dict[str, DataFrame]:
    """Slices of books (book, slice from 1, display_title, start_page, end_page, markdown) to one Markdown a book. refs are blocks with
    provenance (book, slice, ordinal, source_page, block_type, dedupe_key, text_hash, asset_ref, is_overlap, markdown); without them
    the slices' own Markdown is scanned, which knows neither keys nor pages."""
    if refs is None:
        scanned = M.references(slices, ["book", "slice", "start_page"])
        refs = scanned.select("book", "slice", F.col("ordinal").cast("long").alias("ordinal"), F.col("start_page").alias("source_page"), "block_type", F.lit(None).cast("string").alias("dedupe_key"), F.col("normalized_text_hash").alias("text_hash"), "asset_ref", F.lit(False).alias("is_overlap"), "markdown")
    starts = slices.select("book", "slice", F.col("start_page").alias("s"))
    marked = refs.join(starts, ["book", "slice"], "left").withColumn("protected", merge.opens_chapter(F.col("block_type"), F.col("source_page"), F.col("s"), F.col("markdown"))).drop("s")
    kept = merge.deduplicated(marked, "book")
    bodies = merge.stitched(kept.withColumn("__k", F.struct("slice", "ordinal")), "book", "__k", separator="\n\n") if separator == "\n\n" else None
    if bodies is None:
        parts = kept.groupBy("book", "slice").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "markdown"))), lambda x: x["markdown"]), "\n\n").alias("markdown"))
        bodies = merge.stitched(parts, "book", "slice", separator=separator)
    books = bodies.join(slices.groupBy("book").agg(F.count("*").alias("n_slices")), "book")
    gaps = merge.page_gaps(slices.withColumnRenamed("book", "doc_id")).select(F.col("doc_id").alias("book"), F.lit("page_gap").alias("warning_type"))
    warnings = merge.merged_checks(books, doc="book").unionByName(gaps).unionByName(merge.unstable(marked, "book").select("book", "warning_type"))
    return {"books": books, "decisions": merge.decisions(marked, "book"), "warnings": warnings}


def may_merge(documents: DataFrame, allow_review: bool = False) -> DataFrame:
    """Status of each book (book, manual_review_required): aborted if a slice needs review and that isn't allowed."""
    return documents.groupBy("book").agg(F.max("manual_review_required").alias("r")).select("book", F.when(F.col("r") & ~F.lit(allow_review), "aborted_upstream_invalid").otherwise("success").alias("status"))

"""The extract phase: laid-out pages of slices to structured content.

Pages come as one table, whatever parser made them: slice_file, page (from 1 within the slice), width, height, blocks (as in a page
layout), text (Markdown of the page), tables array<snapshot>, images array<struct<asset_path, bbox>>. Slices come with display_title,
start_page, end_page, overlap_pages and manual_review_required."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire import schemas as S
from quire.functions import text as T
from quire.operators import blocks, tables
from quire.session import cut

PAGES = f"slice_file string, page int, width double, height double, blocks array<{S.LAYOUT_BLOCK}>, text string, tables array<{S.SNAPSHOT}>, images array<struct<asset_path:string,bbox:array<double>>>"
SLICES = "slice_file string, display_title string, start_page int, end_page int, overlap_pages array<int>, manual_review_required boolean"
K = ["slice_file", "page"]


def _gathered(df: DataFrame, into: str, order, kind: str, /, **fields) -> DataFrame:
    one = F.struct(*(v.alias(k) for k, v in fields.items()))
    return df.groupBy(*K).agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("__order"), one.alias("x")))), lambda r: r["x"]).cast(f"array<{kind}>").alias(into))


def extract_phase(pages: DataFrame, slices: DataFrame, retry: DataFrame | None = None) -> dict[str, DataFrame]:
    """content (schemas.CONTENT), records (slice_file, status, error_code, warning_count, manual_review_required) and stats.

    ``retry`` holds tables of a second extraction (slice_file, page, tables) for the pages that ``tables.retry_pages`` names. Pages
    of a slice must be numbered from 1 without gaps, else the slice fails; so does one without any content."""
    known = pages.join(slices.select("slice_file", "display_title", "start_page", "overlap_pages"), "slice_file")
    raw = known if retry is None else tables.with_retry(known, retry, K)
    merged = cut(tables.merged_across_pages(raw.select(*K, "height", "tables")))
    clean = cut(tables.sanitized(pages.select(*K, "text"), K))
    heads = known.select(*K, "width", "height", (F.col("start_page") + F.col("page") - 1).alias("source_page"), F.coalesce(F.array_contains("overlap_pages", F.col("start_page") + F.col("page") - 1), F.lit(False)).alias("is_overlap"))

    layout = pages.select(F.col("slice_file").alias("doc_id"), "page", "width", "height", "blocks")
    titles = slices.select(F.col("slice_file").alias("doc_id"), F.col("display_title").alias("title"), F.lit(1).alias("first_page"))
    b = blocks.classified(blocks.text_blocks(layout), titles).withColumnRenamed("doc_id", "slice_file").join(heads.select(*K, "source_page", "is_overlap"), K)
    b = cut(b.withColumns({"bbox": T.round_box("bbox"), "norm": T.normalized(F.col("text"))}))
    key = T.dedupe_key(F.col("source_page"), F.col("norm"), T.bbox_hash(F.col("bbox")))
    block_rows = _gathered(b, "blocks", F.col("reading_order"), S.BLOCK, type=F.col("block_type"), text=F.col("text"), source_page=F.col("source_page"), bbox=F.col("bbox"), reading_order=F.col("reading_order"), is_overlap=F.col("is_overlap"), dedupe_key=key, heading_level=F.col("heading_level"))

    t = merged.join(heads.select(*K, "source_page"), K).select("slice_file", F.col("page").alias("slice_page"), F.col("source_page").alias("page"), F.posexplode("tables").alias("at", "t"))
    t = t.select("slice_file", "slice_page", "page", (F.col("at") + 1).alias("ordinal"), T.round_box("t.bbox").alias("bbox"), F.col("t.headers").alias("headers"), F.col("t.rows").alias("rows"), F.col("t.markdown").alias("markdown"))
    nodes = cut(tables.nodes(t))
    as_page = nodes.withColumnRenamed("page", "source_page").withColumnRenamed("slice_page", "page")
    table_rows = _gathered(as_page, "tables", F.struct("ordinal", "table_id"), S.TABLE, table_id=F.col("table_id"), headers=F.col("headers"), rows=F.col("rows"), markdown=F.col("markdown"), fallback_html=F.col("fallback_html"), fallback_image=F.lit(None).cast("string"), bbox=F.col("bbox"), parent_table_id=F.col("parent_table_id"), table_role=F.col("table_role"), section_title=F.col("section_title"), child_table_ids=F.col("child_table_ids"))

    i = pages.select(*K, "width", "height", F.posexplode("images").alias("at", "i")).select(*K, "width", "height", "at", F.col("i.asset_path").alias("asset_path"), T.round_box("i.bbox").alias("bbox"))
    i = i.withColumn("image_ref", F.col("at").cast("string"))
    bound = cut(i.join(blocks.captions(i, b.withColumn("ordinal", F.col("reading_order")), K), [*K, "image_ref"], "left"))
    image_rows = _gathered(bound, "images", F.col("at"), S.IMAGE, asset_path=F.col("asset_path"), caption=F.col("caption"), bbox=F.col("bbox"), width=F.lit(None).cast("int"), height=F.lit(None).cast("int"))

    page = heads.join(clean, K, "left").join(block_rows, K, "left").join(table_rows, K, "left").join(image_rows, K, "left")
    page = cut(page.withColumns({"markdown": F.coalesce("text", F.lit("")), **{c: F.coalesce(c, F.array().cast(f"array<{k}>")) for c, k in (("blocks", S.BLOCK), ("tables", S.TABLE), ("images", S.IMAGE))}}))

    note = lambda rows, place, *parts: rows.select("slice_file", place.alias("place"), F.concat_ws(":", *parts).alias("warning"))
    notes = note(page.where("markdown = ''"), F.col("page") * 10, F.lit("empty_markdown_page"), F.col("source_page"))
    notes = notes.unionByName(note(page.where("markdown <> '' AND size(blocks) = 0"), F.col("page") * 10 + 1, F.lit("no_blocks_page"), F.col("source_page")))
    notes = notes.unionByName(note(page.where("suppressed > 0"), F.col("page") * 10 + 2, F.lit("suppressed_broken_table_markdown"), F.col("source_page"), F.col("suppressed")))
    notes = notes.unionByName(note(nodes.where("complex AND table_role <> 'child'"), F.col("slice_page") * 10 + 3, F.lit("complex_table"), F.col("page"), F.col("ordinal")))
    notes = notes.unionByName(note(bound.where("caption IS NULL").join(heads.select(*K, "source_page"), K), F.col("page") * 10 + 4, F.lit("image_caption_unbound"), F.col("source_page"), F.col("asset_path")))
    warnings = notes.groupBy("slice_file").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "warning"))), lambda x: x["warning"]).alias("warnings"))

    one = F.struct(F.col("page").alias("slice_page"), "source_page", "is_overlap", "markdown", "blocks", "tables", "images").cast(S.PAGE)
    whole = page.groupBy("slice_file").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", one.alias("p")))), lambda x: x["p"]).alias("source_pages"), F.sum(F.length("markdown")).cast("long").alias("char_count"), F.sum(F.size("blocks")).cast("long").alias("block_count"), F.sum(F.size("tables")).cast("long").alias("table_count"), F.sum(F.size("images")).cast("long").alias("image_count"), F.max("page").alias("last"), F.count("*").alias("n"), F.count_distinct("page").alias("distinct"))
    rows = slices.join(whole, "slice_file", "left").join(warnings, "slice_file", "left").withColumn("warnings", F.coalesce("warnings", F.array().cast("array<string>")))
    empty = F.coalesce(F.col("char_count") + F.col("block_count") + F.col("table_count") + F.col("image_count"), F.lit(0)) == 0
    code = F.when(F.col("n").isNull(), "MISSING_SLICE").when((F.col("last") != F.col("n")) | (F.col("distinct") != F.col("n")), "PAGE_MAPPING").when(empty, "EMPTY_EXTRACTION")
    rows = cut(rows.withColumns({"error_code": code, "review": F.coalesce("manual_review_required", F.lit(False)) | (F.size("warnings") > 0) | code.isNotNull()}))
    good = rows.where("error_code IS NULL")
    return {
        "content": good.select("slice_file", "display_title", "start_page", "end_page", "source_pages", "warnings", F.col("review").alias("manual_review_required")),
        "records": rows.select("slice_file", F.when(F.col("error_code").isNull(), "success").otherwise("failed").alias("status"), "error_code", F.size("warnings").alias("warning_count"), F.col("review").alias("manual_review_required")),
        "stats": good.select("slice_file", "char_count", "table_count", "image_count"),
    }


def drafts(content: DataFrame) -> DataFrame:
    """Markdown of each slice, page by page: doc_id, markdown."""
    parts = F.filter(F.transform("source_pages", tables.page_markdown), lambda m: m != "")
    return content.select(F.col("slice_file").alias("doc_id"), F.concat(F.array_join(parts, "\n\n"), F.lit("\n")).alias("markdown"))

"""Blocks of laid-out pages: texts, types, headings, captions, and what a page's edges look like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T

# How captions and headings begin, and what names of monospaced fonts hold.
CAPTION = r"(?i)^\s*(图|表|figure|fig\.)"
HEADING = r"(?i)^\s*(第[一二三四五六七八九十百零\d]+章|chapter\s+\d+|\d+\.\s+|\d+\.\d+)"
MONO = "cour|mono|consola|code"
#: Gap below an image and shift from its left edge within which a text is its caption, as shares of the page.
CAPTION_GAP, CAPTION_SHIFT = 0.06, 0.12


def line_texts(lines: Column) -> Column:
    return F.filter(F.transform(lines, lambda x: T.strip(F.array_join(F.transform(x["spans"], lambda s: F.coalesce(s["text"], F.lit(""))), ""))), lambda t: t != "")


def fonts(lines: Column) -> Column:
    return F.flatten(F.transform(lines, lambda x: F.transform(x["spans"], lambda s: F.coalesce(s["font"], F.lit("")))))


def largest(lines: Column) -> Column:
    return F.coalesce(F.array_max(F.flatten(F.transform(lines, lambda x: F.transform(x["spans"], lambda s: F.coalesce(s["size"], F.lit(0.0)))))), F.lit(0.0))


def text_blocks(layout: DataFrame) -> DataFrame:
    """One row a text block of page layouts: doc_id, page, reading_order (counted over all text blocks), text, bbox, fonts, size,
    with the page's height and largest font. Blocks without text are counted but not returned."""
    pages = layout.select("doc_id", "page", "width", "height", F.filter("blocks", lambda b: b["type"] == 0).alias("b"))
    pages = pages.withColumn("max_size", F.coalesce(F.array_max(F.transform("b", lambda b: largest(b["lines"]))), F.lit(0.0)))
    rows = pages.select("doc_id", "page", "width", "height", "max_size", F.posexplode("b").alias("at", "block"))
    rows = rows.select("doc_id", "page", "width", "height", "max_size", (F.col("at") + 1).alias("reading_order"), T.strip(F.array_join(line_texts(F.col("block.lines")), "\n")).alias("text"), F.col("block.bbox").alias("bbox"), fonts(F.col("block.lines")).alias("fonts"), largest(F.col("block.lines")).alias("size"))
    return rows.where("text <> ''")


def block_type(text: Column, bbox: Column, fonts_: Column, size: Column, max_size: Column, height: Column, order: Column, first_page: Column, title: Column) -> Column:
    """The first type that fits, in order."""
    titled = first_page & (T.squeeze(text) == T.squeeze(title))
    opening = first_page & (order == 1) & (max_size > 0) & (size >= F.greatest(F.lit(14.0), max_size * 0.95)) & (F.length(text) <= 120)
    top, bottom = F.coalesce(bbox[1], F.lit(0.0)), F.coalesce(bbox[3], F.lit(0.0))
    short = F.length(text) <= 80
    return (
        F.when(F.coalesce(titled | opening, F.lit(False)) | T.looks_like_heading(text, size, max_size), "heading")
        .when(T.is_code_block(text, fonts_), "code")
        .when(T.is_list_item(text), "list_item")
        .when(T.strip(text).startswith(">"), "quote")
        .when((top <= height * 0.08) & short, "header")
        .when((bottom >= height * 0.92) & short, "footer")
        .otherwise("paragraph")
    )


def classified(blocks: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """text_blocks with block_type and heading_level; titles: doc_id, title, first_page."""
    rows = blocks.join(titles, "doc_id", "left") if titles is not None else blocks.withColumns({"title": F.lit(None).cast("string"), "first_page": F.lit(1)})
    kind = block_type(F.col("text"), F.col("bbox"), F.col("fonts"), F.col("size"), F.col("max_size"), F.col("height"), F.col("reading_order"), F.col("page") == F.col("first_page"), F.col("title"))
    rows = rows.withColumn("block_type", kind)
    return rows.withColumn("heading_level", F.when(F.col("block_type") == "heading", T.heading_level(F.col("text"), F.col("size"), F.col("max_size")))).drop("title", "first_page")


def first_last(layout: DataFrame) -> DataFrame:
    """Texts at the top and bottom of each page, with their places and whether they are monospaced."""
    parts = F.transform(F.filter("blocks", lambda b: b["type"] == 0), lambda b: F.struct(F.array_join(line_texts(b["lines"]), " ").alias("text"), b["bbox"].alias("bbox"), F.coalesce(F.exists(fonts(b["lines"]), lambda f: F.lower(f).rlike(MONO)), F.lit(False)).alias("mono")))
    parts = F.filter(parts, lambda p: p["text"] != "")
    # ties go to the block that comes first in the page
    first = F.array_min(F.transform(parts, lambda p, i: F.struct(p["bbox"][1].alias("y"), p["bbox"][0].alias("x"), i.alias("i"), p["text"].alias("text"), p["bbox"].alias("bbox"), p["mono"].alias("mono"))))
    last = F.array_max(F.transform(parts, lambda p, i: F.struct(p["bbox"][3].alias("y"), p["bbox"][0].alias("x"), (-i).alias("i"), p["text"].alias("text"), p["bbox"].alias("bbox"), p["mono"].alias("mono"))))
    return layout.withColumns({"first": first, "last": last})


def boundaries(layout: DataFrame) -> DataFrame:
    """doc_id, page and whether it is safe to cut after it: no table, code, paragraph or figure goes on; the last page is safe."""
    w = W.partitionBy("doc_id").orderBy("page")
    near = lambda boxes, test: F.coalesce(F.exists(boxes, test), F.lit(False))
    pages = first_last(layout).select(
        "doc_id", "page", "height", "first", "last",
        near(F.col("tables"), lambda t: t["bbox"][3] >= F.col("height") * 0.75).alias("table_low"),
        near(F.col("tables"), lambda t: t["bbox"][1] <= F.col("height") * 0.25).alias("table_high"),
        near(F.col("images"), lambda t: t["bbox"][3] >= F.col("height") * 0.7).alias("image_low"),
    )
    nxt = {c: F.lead(c).over(w) for c in ("page", "first", "table_high", "height")}
    pages = pages.withColumns({f"n_{c}": v for c, v in nxt.items()})
    low = F.col("last.bbox")[3] >= F.col("height") * 0.75
    high = F.col("n_first.bbox")[1] <= F.col("n_height") * 0.25
    text = F.col("n_first.text")
    table = F.col("table_low") & F.col("n_table_high")
    code = F.col("last.mono") & F.col("n_first.mono") & low & high
    prose = ~F.col("last.mono") & ~F.col("n_first.mono") & ~text.rlike(HEADING) & ~text.rlike(CAPTION) & low & high & ~T.ends_sentence(T.strip(F.col("last.text")), T.STRUCTURE_ENDS)
    figure = F.col("image_low") & text.rlike(CAPTION) & high
    broken = [F.coalesce(x, F.lit(False)) for x in (table, code, prose, figure)]
    kind = F.when(broken[0], "table").when(broken[1], "code").when(broken[2], "paragraph").when(broken[3], "figure_caption")
    return pages.select("doc_id", "page", F.when(F.col("n_page").isNotNull(), kind).alias("break_type")).withColumn("safe", F.col("break_type").isNull())


def page_titles(layout: DataFrame, **kinds: tuple[str, ...]) -> DataFrame:
    """doc_id, page and, for each kind of patterns, the first block that looks like a title, or null: by its numbering, or a short
    large text near the top. Pages are read once for all kinds."""
    blocks = F.transform(F.filter("blocks", lambda b: b["type"] == 0), lambda b: F.struct(F.array_join(line_texts(b["lines"]), " ").alias("text"), b["bbox"][1].alias("top"), largest(b["lines"]).alias("size"), F.coalesce(F.exists(fonts(b["lines"]), lambda f: F.lower(f).contains("bold")), F.lit(False)).alias("bold")))
    fits = lambda patterns: lambda b: (b["text"] != "") & (b["text"].rlike("|".join(patterns)) | ((b["top"] < F.col("height") * 0.3) & (F.length(b["text"]) <= 80) & ((b["size"] >= 16) | ((b["size"] >= 14) & b["bold"]))))
    pages = layout.select("doc_id", "page", "height", blocks.alias("b"))
    return pages.select("doc_id", "page", *(F.get(F.filter("b", fits(patterns)), F.lit(0))["text"].alias(kind) for kind, patterns in kinds.items()))


def heading_candidates(layout: DataFrame, patterns: tuple[str, ...]) -> DataFrame:
    """The pages that have a title, with it."""
    return page_titles(layout, title=patterns).where("title IS NOT NULL")


def captions(images: DataFrame, blocks: DataFrame, keys: list[str], gap: float = CAPTION_GAP, shift: float = CAPTION_SHIFT) -> DataFrame:
    """Each image with the nearest text below it: images (keys, image_ref, bbox, width, height), blocks (keys, block_type, text,
    bbox, ordinal) to keys, image_ref, caption, gap; null where none is near enough. The first of equally near texts wins."""
    b = blocks.where(F.col("block_type").isin("paragraph", "quote", "list_item")).select(*keys, F.col("text").alias("b_text"), F.col("bbox").alias("b_box"), F.col("ordinal").alias("b_at"))
    distance = F.col("b_box")[1] - F.col("bbox")[3]
    near = (distance >= 0) & (F.abs(F.col("b_box")[0] - F.col("bbox")[0]) <= F.col("width") * shift) & (distance <= F.col("height") * gap)
    pairs = images.join(b, keys, "left").withColumn("best", F.when(near, F.struct(distance.alias("gap"), F.col("b_at"), F.col("b_text"))))
    return pairs.groupBy(*keys, "image_ref").agg(F.min("best").alias("best")).select(*keys, "image_ref", F.col("best.b_text").alias("caption"), F.col("best.gap").alias("gap"))

"""Chapters and sections as page intervals: from a table of contents, else from the layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.blocks import heading_candidates, page_titles

# How titles of chapters and sections begin, and the name of pages before the first chapter.
TOP = (r"^\s*第[一二三四五六七八九十百零\d]+章(?:\b|$)", r"(?i)^\s*chapter\s+\d+\b", r"^\s*\d+\.\s+\S+")
SUB = (r"^\s*\d+\.\d+(?:\.\d+)*\s+\S+", r"(?i)^\s*section\s+\d+(?:\.\d+)*\b")
FRONT = "前言"
#: Pages that a task takes.
TASK = 1 << 14


def intervals(starts: DataFrame, last_page: str = "last_page") -> DataFrame:
    """Rows (doc_id, pos, start_page, last_page, ...) with end_page: the page before the next start, the start at least; the last
    interval ends with last_page."""
    following = F.lead("start_page").over(W.partitionBy("doc_id").orderBy("pos"))
    return starts.withColumn("end_page", F.when(following.isNull(), F.col(last_page)).otherwise(F.greatest("start_page", following - 1)))


def collapsed(starts: DataFrame, keep_last: bool = False) -> DataFrame:
    """Neighbours with one start page become one row: titles joined by " + " unless the next is part of what is joined already,
    or (keep_last) only the last of them."""
    w = W.partitionBy("doc_id").orderBy("pos")
    run = F.sum(F.when(F.col("start_page").eqNullSafe(F.lag("start_page").over(w)), 0).otherwise(1)).over(w)
    groups = starts.withColumn("run", run).groupBy("doc_id", "run").agg(F.min("pos").alias("pos"), F.first("start_page").alias("start_page"), F.array_sort(F.collect_list(F.struct("pos", "title", "level"))).alias("all"))
    joined = F.aggregate(F.slice("all", 2, 1 << 30), F.col("all")[0]["title"], lambda a, x: F.when(F.contains(a, x["title"]), a).otherwise(F.concat(a, F.lit(" + "), x["title"])))
    last = F.element_at("all", -1)
    return groups.select("doc_id", "pos", "start_page", (last["title"] if keep_last else joined).alias("title"), (last["level"] if keep_last else F.col("all")[0]["level"]).alias("level"))


def with_front_matter(chapters: DataFrame, title: str = FRONT) -> DataFrame:
    """A first interval from page 1 where a document's first chapter starts later."""
    first = chapters.groupBy("doc_id").agg(F.min("start_page").alias("s"), F.min("pos").alias("p")).where("s > 1")
    front = first.select("doc_id", (F.col("p") - 1).alias("pos"), F.lit(title).alias("title"), F.lit(1).alias("start_page"), (F.col("s") - 1).alias("end_page"), F.lit(1).alias("level"))
    return chapters.select("doc_id", "pos", "title", "start_page", "end_page", "level").unionByName(front)


def from_toc(toc: DataFrame, pages: DataFrame) -> DataFrame:
    """Top-level entries of tables of contents; pages: doc_id, total_pages."""
    top = toc.where("level = 1 AND page > 0").select("doc_id", "pos", T.strip(F.col("title")).alias("title"), F.col("page").alias("start_page"), "level").where("title <> ''")
    return with_front_matter(intervals(collapsed(top).join(pages.withColumnRenamed("total_pages", "last_page"), "doc_id")))


def titled(layout: DataFrame) -> DataFrame:
    """Pages with the titles that chapters (top) and sections (sub) are found by; stands for the layout in all that follows."""
    return page_titles(layout, top=TOP, sub=SUB)


def dealt(rows: DataFrame, pages: int) -> DataFrame:
    """Rows dealt by document, to a task for each ``TASK`` of all pages at least: what joins them then is dealt alike, so that a task's
    memory does not grow with the input."""
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pages // TASK)), "doc_id")


def _titles(layout: DataFrame, kind: str) -> DataFrame:
    if kind in layout.columns:
        return layout.select("doc_id", "page", F.col(kind).alias("title")).where("title IS NOT NULL")
    return heading_candidates(layout, {"top": TOP, "sub": SUB}[kind])


def from_layout(layout: DataFrame, pages: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Chapters by titles on the pages; a document without any is one chapter with its name (doc_id, name), else its id."""
    found = _titles(layout, "top").select("doc_id", F.col("page").alias("pos"), "title", F.col("page").alias("start_page"), F.lit(1).alias("level"))
    chapters = with_front_matter(intervals(found.join(pages.withColumnRenamed("total_pages", "last_page"), "doc_id")))
    rest = pages.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
    rest = rest.join(names, "doc_id", "left") if names is not None else rest.withColumn("name", F.lit(None).cast("string"))
    whole = rest.select("doc_id", F.lit(1).alias("pos"), F.coalesce("name", F.col("doc_id").cast("string")).alias("title"), F.lit(1).alias("start_page"), F.col("total_pages").alias("end_page"), F.lit(1).alias("level"))
    return chapters.unionByName(whole)


def recognize(toc: DataFrame, layout: DataFrame, pages: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Chapters of each document with fallback_level 1 (contents) or 2 (layout)."""
    by_toc = from_toc(toc, pages)
    known = by_toc.select("doc_id").distinct()
    others = from_layout(layout.join(known, "doc_id", "left_anti"), pages.join(known, "doc_id", "left_anti"), names)
    return by_toc.withColumn("fallback_level", F.lit(1)).unionByName(others.withColumn("fallback_level", F.lit(2)))


def sections(chapters: DataFrame, toc: DataFrame, layout: DataFrame) -> DataFrame:
    """Sections within each chapter (doc_id, chapter, pos, title, start_page, end_page, level): deeper entries of the contents, the
    last of those on one page; without any, titles on the pages. Pages before the first section carry the chapter's title."""
    c = chapters.select("doc_id", F.col("pos").alias("chapter"), F.col("title").alias("c_title"), F.col("start_page").alias("c_start"), F.col("end_page").alias("c_end"), F.col("level").alias("c_level"))
    inside = F.col("page").between(F.col("c_start"), F.col("c_end"))
    entries = c.join(toc.select("doc_id", "pos", "level", T.strip(F.col("title")).alias("title"), "page"), "doc_id").where(inside & (F.col("level") > F.col("c_level")) & (F.col("title") != ""))
    entries = entries.select("doc_id", "chapter", "c_title", "c_start", "c_end", "c_level", "pos", "title", F.col("page").alias("start_page"), "level")
    known = entries.select("doc_id", "chapter").distinct()
    seen = c.join(known, ["doc_id", "chapter"], "left_anti").join(_titles(layout, "sub"), "doc_id").where(inside)
    both = entries.unionByName(seen.select("doc_id", "chapter", "c_title", "c_start", "c_end", "c_level", F.col("page").alias("pos"), "title", F.col("page").alias("start_page"), (F.col("c_level") + 1).alias("level")))
    w = W.partitionBy("doc_id", "chapter").orderBy("pos")
    last = both.withColumn("n", F.lead("start_page").over(w)).where(~F.col("start_page").eqNullSafe(F.col("n")))
    following = F.lead("start_page").over(w)
    rows = last.select("*", F.when(following.isNull(), F.col("c_end")).otherwise(F.greatest("start_page", following - 1)).alias("end_page"), F.row_number().over(w).alias("k"))
    front = rows.where("k = 1 AND start_page > c_start").select("doc_id", "chapter", (F.col("pos") - 1).alias("pos"), F.col("c_title").alias("title"), F.col("c_start").alias("start_page"), (F.col("start_page") - 1).alias("end_page"), (F.col("c_level") + 1).alias("level"))
    return rows.select("doc_id", "chapter", "pos", "title", "start_page", "end_page", "level").unionByName(front)

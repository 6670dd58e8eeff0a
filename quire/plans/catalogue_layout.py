"""Registered queries of pages, blocks, chapters and slice plans over documents laid out as pages, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import blocks, chapters, planner
from quire.plans.catalogue import LINES, query
from quire.schemas import SLICE
from quire.session import cut
from quire.sources import adapters


def _docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def _layout(spark, sf):
    return adapters.layout(_docs(spark, sf))


SPACE = "'^\\s+|\\s+$', '', 'g'"
LAID = f"""{LINES}, placed AS (SELECT doc_id, reading_order - 1 AS n0, CAST((reading_order - 1) // 4 + 1 AS INTEGER) AS page, CAST((reading_order - 1) % 4 AS INTEGER) AS i, text AS line FROM lines),
shown AS (SELECT *, CASE WHEN i = 0 AND page % 3 = 1 THEN 'Chapter ' || page || ' ' || left(line, 20) WHEN i = 0 AND page % 3 = 2 THEN 'Figure ' || page || ' ' || left(line, 20) WHEN i = 1 AND page % 2 = 0 THEN page || '.1 ' || left(line, 60)
 WHEN i = 2 AND page % 2 = 0 THEN '- ' || left(line, 40) WHEN i = 2 AND page % 3 = 1 THEN '> ' || line ELSE line END AS shown FROM placed),
laid AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, n0, page, i, regexp_replace(shown, {SPACE}) AS t, CASE WHEN length(shown) <= 40 THEN 20.0 WHEN length(shown) <= 80 THEN 15.0 ELSE 11.0 END AS size, regexp_matches(line, '[0-9]') OR n0 % 8 IN (3, 4) AS mono,
 50 + 10 * i AS x0, 30 + 250 * i AS y0, 230 + 250 * i AS y1 FROM shown),
sized AS (SELECT *, max(size) OVER (PARTITION BY doc_id, page) AS largest FROM laid)"""
NUMBERING = """CASE WHEN regexp_matches(t, '^第[一二三四五六七八九十百千万]+[章篇]') OR regexp_matches(t, '^附录') THEN 1 WHEN regexp_matches(t, '^第[一二三四五六七八九十百千万]+节') THEN 2
 WHEN regexp_matches(t, '^[A-Za-z]?[0-9]') THEN least(6, len(string_split(regexp_extract(t, '^[A-Za-z]?([0-9]+(\\.[0-9]+)*)', 1), '.'))) END"""
SHARE = "CASE WHEN size / largest >= 0.95 THEN 1 WHEN size / largest >= 0.8 THEN 2 WHEN size / largest >= 0.65 THEN 3 END"
HEADLIKE = "largest > 0 AND size >= 14 AND size >= largest * 0.85 AND length(t) <= 120 AND regexp_matches(t, '^(?:\\d+(?:\\.\\d+){0,5}|[A-Za-z]\\d+(?:\\.\\d+){0,5}|第[一二三四五六七八九十百千万]+[章节篇]|附录[A-Za-z0-9一二三四五六七八九十]*)[\\s.:：、)）\\-].+')"
TYPED = f"""{LAID}, typed AS (SELECT *, CASE WHEN (page = 1 AND i = 0 AND size >= greatest(14, largest * 0.95) AND length(t) <= 120) OR ({HEADLIKE}) THEN 'heading' WHEN mono THEN 'code' WHEN regexp_matches(t, '^\\s*(?:[-*•] |\\d+[.)]\\s)') THEN 'list_item'
 WHEN starts_with(t, '>') THEN 'quote' WHEN y0 <= 80 AND length(t) <= 80 THEN 'header' WHEN y1 >= 920 AND length(t) <= 80 THEN 'footer' ELSE 'paragraph' END AS block_type FROM sized WHERE t <> '')"""


@query(f"WITH {LAID} SELECT doc_id, page, i + 1 AS reading_order, t AS text, CAST(size AS DOUBLE) AS size FROM laid WHERE t <> ''")
def prj_text_blocks(spark, sf):
    return blocks.text_blocks(_layout(spark, sf)).select("doc_id", "page", "reading_order", "text", "size")


@query(f"WITH {TYPED} SELECT doc_id, page, i + 1 AS reading_order, block_type, CASE WHEN block_type = 'heading' THEN CAST(coalesce({NUMBERING}, {SHARE}, 2) AS INTEGER) END AS heading_level FROM typed")
def prd_block_types(spark, sf):
    return blocks.classified(blocks.text_blocks(_layout(spark, sf))).select("doc_id", "page", "reading_order", "block_type", F.col("heading_level").cast("int").alias("heading_level"))


@query(f"WITH {LAID} SELECT doc_id, page, i, coalesce({HEADLIKE}, FALSE) AS is_heading, CAST({NUMBERING} AS INTEGER) AS level FROM sized WHERE t <> ''")
def prd_headings(spark, sf):
    """What looks like a heading, and the level of its numbering."""
    b = blocks.text_blocks(_layout(spark, sf))
    return b.select("doc_id", "page", (F.col("reading_order") - 1).alias("i"), T.looks_like_heading(F.col("text"), F.col("size"), F.col("max_size")).alias("is_heading"), T.level_of_numbering(F.col("text")).cast("int").alias("level"))


CODED = "SELECT doc_id, page, string_agg(CASE WHEN n0 % 5 = 1 THEN '    ' || line WHEN n0 % 5 = 3 THEN 'return ' || line ELSE line END, chr(10) ORDER BY n0) AS t FROM placed GROUP BY doc_id, page"


@query(f"""WITH {LAID}, pages_ AS ({CODED}), l AS (SELECT doc_id, page, list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, {SPACE}) <> '') AS ls FROM pages_),
c AS (SELECT *, len(ls) AS n, len(list_filter(ls, lambda x: regexp_matches(x, '^(    |\\t)'))) AS indented, len(list_filter(ls, lambda x: regexp_matches(x, '(?i)^\\s*(def|class|for|if|while|return|import|from|try|except|with)\\b'))) AS words,
 len(list_filter(ls, lambda x: regexp_matches(x, '[:=(){{}}\\[\\].,]|->|=>'))) AS marks FROM l)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, page, n >= 2 AND (indented >= greatest(2.0, n * 0.6) OR (words > 0 AND marks > 0) OR (n >= 3 AND marks >= n * 0.7)) AS is_code FROM c""")
def prd_code_block(spark, sf):
    lines = _docs(spark, sf).select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    text = F.when(F.col("at") % 5 == 1, F.concat(F.lit("    "), "line")).when(F.col("at") % 5 == 3, F.concat(F.lit("return "), "line")).otherwise(F.col("line"))
    pages = lines.groupBy("doc_id", (F.floor(F.col("at") / 4) + 1).cast("int").alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", text.alias("t")))), lambda x: x["t"]), "\n").alias("t"))
    return pages.select("doc_id", "page", T.is_code_block(F.col("t"), F.array(F.lit("Serif"))).alias("is_code"))


EDGES = f"{LAID}, e AS (SELECT doc_id, page, arg_min(laid, (y0, x0, i)) AS a, arg_max(laid, (y1, x0, -i)) AS z FROM laid WHERE t <> '' GROUP BY doc_id, page)"
ALL_EDGES = f"{EDGES}, p AS (SELECT DISTINCT doc_id, page FROM laid), x AS (SELECT p.doc_id, p.page, e.a, e.z, lead(e.a) OVER w AS b, lead(p.page) OVER w AS n FROM p LEFT JOIN e USING (doc_id, page) WINDOW w AS (PARTITION BY p.doc_id ORDER BY p.page))"
BEGINS = "'(?i)^\\s*(第[一二三四五六七八九十百零\\d]+章|chapter\\s+\\d+|\\d+\\.\\s+|\\d+\\.\\d+)'"
CAPTION = "'(?i)^\\s*(图|表|figure|fig\\.)'"


@query(f"WITH {EDGES} SELECT doc_id, page, a.t AS first_text, z.t AS last_text, a.mono AS first_mono FROM e")
def win_edges_of_pages(spark, sf):
    return blocks.first_last(_layout(spark, sf)).where("first IS NOT NULL").select("doc_id", "page", F.col("first.text").alias("first_text"), F.col("last.text").alias("last_text"), F.col("first.mono").alias("first_mono"))


@query(f"""WITH {ALL_EDGES}, k AS (SELECT *, page % 4 = 0 AND n % 4 = 1 AS is_table, coalesce(z.y1 >= 750 AND b.y0 <= 250, FALSE) AS meet FROM x)
SELECT doc_id, page, CASE WHEN n IS NULL THEN NULL WHEN is_table THEN 'table' WHEN meet AND z.mono AND b.mono THEN 'code'
 WHEN meet AND NOT z.mono AND NOT b.mono AND NOT regexp_matches(b.t, {BEGINS}) AND NOT regexp_matches(b.t, {CAPTION}) AND NOT contains('。！？.!?;；:：”」』）)]', right(z.t, 1)) THEN 'paragraph'
 WHEN page % 5 = 2 AND regexp_matches(b.t, {CAPTION}) AND b.y0 <= 250 THEN 'figure_caption' END AS break_type FROM k""")
def prd_boundary_breaks(spark, sf):
    return blocks.boundaries(_layout(spark, sf)).select("doc_id", "page", "break_type")


@query(f"""WITH {TYPED}, i AS (SELECT DISTINCT doc_id, page FROM laid WHERE page % 5 = 2), c AS (SELECT i.doc_id, i.page, t.t AS caption, t.y0 - 770 AS gap, row_number() OVER (PARTITION BY i.doc_id, i.page ORDER BY t.y0, t.i) AS k
 FROM i JOIN typed t USING (doc_id, page) WHERE t.block_type IN ('paragraph', 'quote', 'list_item') AND t.y0 >= 770 AND abs(t.x0 - 55) <= 72 AND t.y0 - 770 <= 60)
SELECT doc_id, page, caption, CAST(gap AS DOUBLE) AS gap FROM i LEFT JOIN (SELECT * FROM c WHERE k = 1) c USING (doc_id, page)""")
def jn_captions_of_pages(spark, sf):
    pages = _layout(spark, sf)
    images = pages.select("doc_id", "page", "width", "height", F.posexplode("images").alias("n", "im")).select("doc_id", "page", "width", "height", F.col("n").alias("image_ref"), F.col("im.bbox").alias("bbox"))
    b = blocks.classified(blocks.text_blocks(pages)).withColumn("ordinal", F.col("reading_order"))
    return blocks.captions(images, b, ["doc_id", "page"]).select("doc_id", "page", "caption", "gap")


TOP = "'^\\s*第[一二三四五六七八九十百零\\d]+章$|(?i)^\\s*chapter\\s+\\d+\\b|^\\s*\\d+\\.\\s+\\S+'"
SUB = "'^\\s*\\d+\\.\\d+(?:\\.\\d+)*\\s+\\S+|(?i)^\\s*section\\s+\\d+(?:\\.\\d+)*\\b'"


def _titles(patterns: str) -> str:
    return f"SELECT doc_id, page, arg_min(t, i) AS title FROM laid WHERE t <> '' AND (regexp_matches(t, {patterns}) OR (y0 < 300 AND length(t) <= 80 AND size >= 16)) GROUP BY doc_id, page"


TOC = "toc AS (SELECT doc_id, n0 AS pos, CAST(2 - (n0 // 6) % 2 AS INTEGER) AS level, regexp_replace('<' || n0 || '> ' || left(line, 12), '\\s+$', '') AS title, page FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, n0, page, line FROM placed WHERE doc_id % 2 = 0 AND n0 % 6 = 0))"
FOUND = f"""{LAID}, {TOC}, total AS (SELECT doc_id, max(page) AS total FROM laid GROUP BY doc_id), top AS ({_titles(TOP)}),
merged AS (SELECT doc_id, page, min(pos) AS pos, string_agg(title, ' + ' ORDER BY pos) AS title FROM toc WHERE level = 1 GROUP BY doc_id, page),
starts AS (SELECT doc_id, pos, title, page AS start_page, 1 AS kind FROM merged UNION ALL SELECT doc_id, page, title, page, 2 FROM top WHERE doc_id NOT IN (SELECT doc_id FROM merged)),
spans AS (SELECT s.doc_id, s.pos, s.title, s.start_page, CASE WHEN lead(s.start_page) OVER (PARTITION BY s.doc_id ORDER BY s.pos) IS NULL THEN total ELSE greatest(s.start_page, lead(s.start_page) OVER (PARTITION BY s.doc_id ORDER BY s.pos) - 1) END AS end_page, kind FROM starts s JOIN total USING (doc_id)),
chapters AS (SELECT doc_id, pos, title, start_page, end_page, kind FROM spans UNION ALL SELECT doc_id, min(pos) - 1, '前言', 1, min(start_page) - 1, any_value(kind) FROM spans GROUP BY doc_id HAVING min(start_page) > 1
 UNION ALL SELECT doc_id, 1, doc_id, 1, total, 2 FROM total WHERE doc_id NOT IN (SELECT doc_id FROM starts))"""


@query(f"WITH {LAID}, t AS ({_titles(TOP)}) SELECT * FROM t")
def win_page_titles(spark, sf):
    return blocks.heading_candidates(_layout(spark, sf), chapters.TOP)


def _titled(spark, sf):
    """Pages with their titles, and contents, dealt alike."""
    pages = cut(chapters.titled(_layout(spark, sf)))
    n = pages.count()
    return chapters.dealt(pages, n), chapters.dealt(adapters.contents(_docs(spark, sf)), n)


def _chapters(pages, contents):
    return chapters.recognize(contents, pages, pages.groupBy("doc_id").agg(F.max("page").alias("total_pages")))


@query(f"WITH {FOUND} SELECT doc_id, title, CAST(start_page AS INTEGER) AS start_page, CAST(end_page AS INTEGER) AS end_page, kind AS fallback_level FROM chapters")
def str_chapters(spark, sf):
    return _chapters(*_titled(spark, sf)).select("doc_id", "title", F.col("start_page").cast("int").alias("start_page"), F.col("end_page").cast("int").alias("end_page"), "fallback_level")


@query(f"""WITH {FOUND}, sub AS ({_titles(SUB)}), c AS (SELECT doc_id, pos AS chapter, title AS c_title, start_page AS c_start, end_page AS c_end FROM chapters),
entries AS (SELECT c.*, t.pos, t.title, t.page, t.level FROM c JOIN toc t USING (doc_id) WHERE t.page BETWEEN c_start AND c_end AND t.level > 1),
both_ AS (SELECT * FROM entries UNION ALL SELECT c.*, s.page, s.title, s.page, 2 FROM c JOIN sub s USING (doc_id) WHERE s.page BETWEEN c_start AND c_end AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.doc_id = c.doc_id AND e.chapter = c.chapter)),
lasts AS (SELECT * FROM (SELECT *, lead(page) OVER (PARTITION BY doc_id, chapter ORDER BY pos) AS n FROM both_) WHERE page IS DISTINCT FROM n),
ends AS (SELECT *, CASE WHEN lead(page) OVER w IS NULL THEN c_end ELSE greatest(page, lead(page) OVER w - 1) END AS end_page, row_number() OVER w AS k FROM lasts WINDOW w AS (PARTITION BY doc_id, chapter ORDER BY pos))
SELECT doc_id, title, CAST(page AS INTEGER) AS start_page, CAST(end_page AS INTEGER) AS end_page, CAST(level AS INTEGER) AS level FROM ends
UNION ALL SELECT doc_id, c_title, CAST(c_start AS INTEGER), CAST(page - 1 AS INTEGER), 2 FROM ends WHERE k = 1 AND page > c_start""")
def str_sections(spark, sf):
    pages, contents = _titled(spark, sf)
    found = chapters.dealt(cut(_chapters(pages, contents).drop("fallback_level")), pages.count())
    return chapters.sections(found, contents, pages).select("doc_id", "title", F.col("start_page").cast("int").alias("start_page"), F.col("end_page").cast("int").alias("end_page"), F.col("level").cast("int").alias("level"))


# Plans: a line is a page, and a cut is safe after a line that ends with a full stop.
SAFE = "safe AS (SELECT doc_id, list(reading_order ORDER BY reading_order) AS safe FROM lines WHERE text LIKE '%.' GROUP BY doc_id), d AS (SELECT l.doc_id, CAST(max(l.reading_order) AS BIGINT) AS n FROM lines l GROUP BY l.doc_id), ds AS (SELECT d.doc_id, d.n, coalesce(safe, []) AS safe FROM d LEFT JOIN safe USING (doc_id))"
NEAREST = "(SELECT arg_min(p, (abs(p - {want}), {side})) FROM (SELECT unnest(x.safe) AS p) WHERE p BETWEEN {low} AND {high})"
FIRST = "(SELECT min(p) FROM (SELECT unnest(x.safe) AS p) WHERE p BETWEEN {low} AND {high})"


def _paged(spark, sf):
    lines = adapters.blocks(_docs(spark, sf), False)
    page = F.col("reading_order").cast("int")
    return lines.groupBy("doc_id").agg(F.max(page).alias("n"), F.array_sort(F.collect_list(F.when(F.col("text").endswith("."), page))).alias("safe"), F.map_from_entries(F.collect_list(F.struct(page, "text"))).alias("texts"))


def _slices(df, plan):
    return df.select("doc_id", F.posexplode(plan).alias("pos", "s")).select("doc_id", F.col("pos").cast("int").alias("pos"), "s.start_page", "s.end_page", "s.boundary_reason", "s.exception_type", "s.manual_review_required")


TARGET, MOST = 4, 6


@query(f"""WITH RECURSIVE {LINES}, {SAFE}, f AS (SELECT doc_id, n, safe, 1::BIGINT AS at, -1 AS pos, 0::BIGINT AS stop, ''::VARCHAR AS reason, NULL::VARCHAR AS problem FROM ds
 UNION ALL SELECT x.doc_id, x.n, x.safe, y.stop + 1, x.pos + 1, y.stop, y.reason, y.problem FROM f x, LATERAL (SELECT {NEAREST.format(want="(x.at + 3)", side="CASE WHEN p > x.at + 3 THEN 1 ELSE 0 END", low="x.at", high="least(x.at + 5, x.n - 1)")} AS near, {FIRST.format(low="least(x.at + 5, x.n - 1) + 1", high="x.n - 1")} AS far) c,
 LATERAL (SELECT CASE WHEN x.n - x.at + 1 <= 6 THEN x.n ELSE coalesce(near, far, x.n) END AS stop, CASE WHEN x.n - x.at + 1 <= 4 THEN 'fallback_physical' WHEN x.n - x.at + 1 <= 6 THEN 'semantic_integrity' WHEN near = x.at + 3 THEN 'page_limit' ELSE 'semantic_integrity' END AS reason,
  CASE WHEN x.n - x.at + 1 <= 6 OR near IS NOT NULL THEN NULL WHEN far IS NOT NULL THEN 'oversized_semantic_block' ELSE 'oversized_section' END AS problem) y WHERE x.at <= x.n)
SELECT doc_id, pos, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY pos) + 1 AS start_page, stop AS end_page, reason AS boundary_reason, problem AS exception_type, problem IS NOT NULL AS manual_review_required FROM f WHERE pos >= 0""")
def fld_physical_slices(spark, sf):
    rows = _paged(spark, sf)
    out = _slices(rows, planner.physical(F.lit("t"), F.lit(1), F.col("n"), F.lit(1), F.col("safe"), TARGET, MOST))
    return out.withColumns({c: F.col(c).cast("long") for c in ("start_page", "end_page")})


def _fixed(rows):
    """Slices of four pages, whatever the text."""
    one = lambda k: F.struct(F.concat(F.lit("C"), k.cast("string")), (k * 4 + 1).cast("int"), F.least(k * 4 + 4, F.col("n")).cast("int"), F.lit("chapter"), F.array().cast("array<int>"), F.lit("chapter_boundary"), F.lit(None).cast("string"), F.lit(False), F.lit(1)).cast(SLICE)
    return rows.withColumns({"plan": F.transform(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 4).cast("int")), one), "starts": F.transform(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 12).cast("int")), lambda k: k * 12 + 1)})


@query(f"""WITH RECURSIVE {LINES}, {SAFE}, g AS (SELECT doc_id, unnest(range((n - 1) // 4 + 1)) AS k, n FROM d),
f AS (SELECT doc_id, n, safe, 0::BIGINT AS k, 1::BIGINT AS s, least(4, n) AS e, -1::BIGINT AS done_s, -1::BIGINT AS done_e, 'chapter_boundary'::VARCHAR AS reason, NULL::VARCHAR AS problem, FALSE AS review, ''::VARCHAR AS done_reason, NULL::VARCHAR AS done_problem, FALSE AS done_review FROM ds
 UNION ALL SELECT x.doc_id, x.n, x.safe, x.k + 1, y.ns, y.ne, x.s, y.ce, y.nr, NULL, FALSE, y.cr, y.cp, y.cv FROM f x, LATERAL (SELECT x.k * 4 + 5 AS a, least(x.k * 4 + 8, x.n) AS z) nx,
 LATERAL (SELECT x.e >= z OR x.e >= x.n OR list_contains(x.safe, x.e) OR ((a - 1) % 12 = 0 AND x.e + 1 = a) AS settled) st,
 LATERAL (SELECT coalesce({NEAREST.format(want="x.e", side="CASE WHEN p < x.e THEN 1 ELSE 0 END", low="x.s", high="least(x.s + 5, z - 1)")}, {FIRST.format(low="least(x.s + 5, z - 1) + 1", high="z - 1")}) AS go) t,
 LATERAL (SELECT CASE WHEN settled OR go IS NULL THEN x.e ELSE go END AS ce, CASE WHEN settled THEN x.reason ELSE 'semantic_integrity' END AS cr, CASE WHEN settled THEN x.problem WHEN go IS NULL OR go - x.s + 1 > 6 THEN coalesce(x.problem, 'oversized_semantic_block') ELSE x.problem END AS cp,
  CASE WHEN settled THEN x.review WHEN go IS NULL OR go - x.s + 1 > 6 THEN TRUE ELSE x.review END AS cv, CASE WHEN settled OR go IS NULL THEN a ELSE go + 1 END AS ns, z AS ne, CASE WHEN settled OR go IS NULL THEN 'chapter_boundary' ELSE 'semantic_integrity' END AS nr) y WHERE nx.a <= x.n)
SELECT doc_id, CAST(k - 1 AS INTEGER) AS pos, done_s AS start_page, done_e AS end_page, done_reason AS boundary_reason, done_problem AS exception_type, done_review AS manual_review_required FROM f WHERE k > 0
UNION ALL SELECT doc_id, CAST(k AS INTEGER), s, e, reason, problem, review FROM f WHERE k = (n - 1) // 4""")
def fld_moved_boundaries(spark, sf):
    out = _slices(_fixed(_paged(spark, sf)), planner.moved_boundaries(F.col("plan"), F.col("safe"), F.col("starts"), F.col("n"), MOST))
    return out.withColumns({c: F.col(c).cast("long") for c in ("start_page", "end_page")})


@query(f"""WITH {LINES}, d AS (SELECT doc_id, CAST(max(reading_order) AS INTEGER) AS n FROM lines GROUP BY doc_id), g AS (SELECT doc_id, n, unnest(range((n - 1) // 4 + 1)) AS k FROM d), p AS (SELECT doc_id, CAST(k AS INTEGER) AS pos, k * 4 + 1 AS s, least(k * 4 + 4, n) AS e FROM g),
q AS (SELECT p.*, lead(s) OVER w AS ns, coalesce(((lead(s) OVER w) - 1) % 12 = 0 OR contains(l.text, 'tion'), FALSE) AS shares FROM p LEFT JOIN lines l ON l.doc_id = p.doc_id AND l.reading_order = p.s + 4 WINDOW w AS (PARTITION BY p.doc_id ORDER BY pos)),
r AS (SELECT *, shares AND ns IS NOT NULL AS nxt, coalesce(lag(shares AND ns IS NOT NULL) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) AS before FROM q)
SELECT doc_id, pos, CAST(s AS INTEGER) AS start_page, CAST(CASE WHEN nxt THEN ns ELSE e END AS INTEGER) AS end_page, array_to_string(list_distinct_ordered, ',') AS overlap_pages, CASE WHEN nxt AND ns - s + 1 > 4 THEN 'oversized_semantic_block' END AS exception_type
FROM (SELECT *, list_concat(CASE WHEN before THEN [s] ELSE [] END, CASE WHEN nxt THEN [ns] ELSE [] END) AS list_distinct_ordered FROM r)""")
def fld_overlap_pages(spark, sf):
    """A page is shared where a chapter starts or the title, here a common syllable, is named on it."""
    rows = _fixed(_paged(spark, sf))
    plan = F.transform("plan", lambda s: F.struct(F.lit("tion"), s["start_page"], s["end_page"], s["split_mode"], s["overlap_pages"], s["boundary_reason"], s["exception_type"], s["manual_review_required"], s["toc_level"]).cast(SLICE))
    # only the page that the next slice starts with is looked at: the others' texts are left out
    texts = F.map_filter("texts", lambda k, _: k % 4 == 1)
    out = rows.withColumn("o", planner.with_overlap(plan, F.col("starts"), texts, 4)).select("doc_id", F.posexplode("o").alias("pos", "s"))
    return out.select("doc_id", F.col("pos").cast("int").alias("pos"), "s.start_page", "s.end_page", F.array_join(F.col("s.overlap_pages").cast("array<string>"), ",").alias("overlap_pages"), "s.exception_type")


@query(f"""WITH {LINES}, s AS (SELECT doc_id, reading_order, CAST(length(text) % 40 + 1 AS INTEGER) AS pages, [NULL, 'oversized_section', 'oversized_semantic_block', 'other'][CAST(reading_order % 4 AS INTEGER) + 1] AS problem FROM lines)
SELECT doc_id, CAST(reading_order AS INTEGER) AS pos, CASE WHEN pages <= 25 AND problem LIKE 'oversized%' THEN NULL ELSE problem END AS exception_type, NOT coalesce(pages <= 25 AND problem LIKE 'oversized%', FALSE) AS manual_review_required FROM s""")
def fld_settled_flags(spark, sf):
    lines = adapters.blocks(_docs(spark, sf), False)
    problem = F.get(F.array(F.lit(None).cast("string"), F.lit("oversized_section"), F.lit("oversized_semantic_block"), F.lit("other")), (F.col("reading_order") % 4).cast("int"))
    one = F.struct(F.col("text"), F.lit(1), (F.length("text") % 40 + 1).cast("int"), F.lit("section"), F.array().cast("array<int>"), F.lit("section_boundary"), problem, F.lit(True), F.lit(1)).cast(SLICE)
    rows = lines.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("reading_order", one.alias("s")))), lambda x: x["s"]).alias("plan"))
    return rows.select("doc_id", F.posexplode(planner.settled_flags(F.col("plan"))).alias("pos", "s")).select("doc_id", (F.col("pos") + 1).cast("int").alias("pos"), "s.exception_type", "s.manual_review_required")


@query(f"""WITH {LINES}, s AS (SELECT doc_id, reading_order AS pos, left(text, 6) AS title, CAST(reading_order % 3 + 1 AS INTEGER) AS a, CAST(reading_order % 3 + 2 AS INTEGER) AS z FROM lines),
b AS (SELECT *, coalesce(nullif(trim(regexp_replace(title, '[<>:"/\\\\|?*]', '_', 'g'), ' '), ''), '未命名章节') || '（' || a || '-' || z || '）' AS base FROM s), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY pos) AS k FROM b)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, base || CASE WHEN k > 1 THEN '_' || lpad(CAST(k AS VARCHAR), 2, '0') ELSE '' END || '.pdf' AS slice_file FROM n""")
def agg_slice_names(spark, sf):
    rows = adapters.blocks(_docs(spark, sf), False).select("doc_id", F.col("reading_order").cast("int").alias("pos"), F.left("text", F.lit(6)).alias("title"), (F.col("reading_order") % 3 + 1).cast("int").alias("start_page"), (F.col("reading_order") % 3 + 2).cast("int").alias("end_page"))
    return planner.slice_names(rows).select("doc_id", "pos", "slice_file")


def _physical(target: int, most: int) -> str:
    near = NEAREST.format(want=f"(x.p0 + {target - 1})", side=f"CASE WHEN p > x.p0 + {target - 1} THEN 1 ELSE 0 END", low="x.p0", high=f"least(x.p0 + {most - 1}, x.n - 1)")
    far = FIRST.format(low=f"least(x.p0 + {most - 1}, x.n - 1) + 1", high="x.n - 1")
    return f"""f AS (SELECT doc_id, n, safe, 1::BIGINT AS p0, 0 AS pos, 0::BIGINT AS start_page, 0::BIGINT AS stop, ''::VARCHAR AS reason, NULL::VARCHAR AS problem FROM ds WHERE n > {most}
 UNION ALL SELECT x.doc_id, x.n, x.safe, y.stop + 1, x.pos + 1, x.p0, y.stop, y.reason, y.problem FROM f x, LATERAL (SELECT {near} AS near, {far} AS far) c,
 LATERAL (SELECT CASE WHEN x.n - x.p0 + 1 <= {most} THEN x.n ELSE coalesce(near, far, x.n) END AS stop, CASE WHEN x.n - x.p0 + 1 <= {target} THEN 'fallback_physical' WHEN x.n - x.p0 + 1 <= {most} THEN 'semantic_integrity' WHEN near = x.p0 + {target - 1} THEN 'page_limit' ELSE 'semantic_integrity' END AS reason,
  CASE WHEN x.n - x.p0 + 1 <= {most} OR near IS NOT NULL THEN NULL WHEN far IS NOT NULL THEN 'oversized_semantic_block' ELSE 'oversized_section' END AS problem) y WHERE x.p0 <= x.n)"""


@query(f"""WITH RECURSIVE {LINES}, {SAFE}, {_physical(5, 7)} SELECT doc_id, pos, start_page, stop AS end_page, 'physical' AS split_mode, reason AS boundary_reason, CASE WHEN stop - start_page + 1 > 7 THEN problem END AS exception_type FROM f WHERE pos > 0
UNION ALL SELECT doc_id, 1, 1, n, 'chapter', 'chapter_boundary', NULL FROM ds WHERE n <= 7""")
def fld_full_plan(spark, sf):
    """Documents of one chapter: whole if they fit, else cut at safe pages."""
    rows = _paged(spark, sf)
    one = F.struct(F.lit("C"), F.lit(1), F.col("n"), F.lit(1), F.lit(None).cast("array<struct<title:string,start_page:int,end_page:int,level:int>>")).cast("struct<title:string,start_page:int,end_page:int,level:int,sections:array<struct<title:string,start_page:int,end_page:int,level:int>>>")
    out = planner.plan(rows.select("doc_id", F.col("n").alias("last_page"), F.array(one).alias("chapters"), "safe", "texts"), 5, 7, 2)
    return out.select("doc_id", F.col("pos").cast("int").alias("pos"), F.col("start_page").cast("long").alias("start_page"), F.col("end_page").cast("long").alias("end_page"), "split_mode", "boundary_reason", "exception_type")

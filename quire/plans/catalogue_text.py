"""Registered queries of cells, tables, repairs, alignment and Markdown over rows made from documents, and the same in SQL.

The rows are made alike on both sides from the first words of each line, so that every branch of an operator is met many times."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import cells, markdown
from quire.functions import text as T
from quire.operators import align, merge, repair, tables
from quire.plans import phases
from quire.plans.catalogue import LINES, query
from quire.schemas import SNAPSHOT
from quire.session import cut
from quire.sources import adapters, manifests

FOUR = f"""{LINES}, w AS (SELECT doc_id, CAST(reading_order - 1 AS BIGINT) AS n0, text AS line, list_filter(string_split(text, ' '), lambda x: x <> '') AS ws FROM lines),
four AS (SELECT doc_id, n0, line, {', '.join(f"lower(regexp_replace(coalesce(ws[{i + 1}], ''), '[^A-Za-z]', '', 'g')) AS {c}" for i, c in enumerate("abcd"))} FROM w)"""
NL = "chr(10)"


def _docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def _four(spark, sf):
    return adapters.four_words(_docs(spark, sf))


def _by(column, n, *values):
    """The value for column % n."""
    out = F.when(column % n == 0, values[0])
    for i, v in enumerate(values[1:], start=1):
        out = out.when(column % n == i, v)
    return out


def _sql_by(column, n, *values):
    return "CASE " + " ".join(f"WHEN {column} % {n} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


C = F.concat
lit = F.lit
DIGITS = "CAST(n0 % 10 AS VARCHAR)"

# ---- cells
CONNECTORS = "('a', 'an', 'and', 'as', 'at', 'by', 'for', 'from', 'in', 'into', 'of', 'on', 'or', 'the', 'to', 'with')"
LEFT = _sql_by("n0", 6, "a", "c || upper(left(a, 1)) || substr(a, 2)", "a || ':'", f"a || {DIGITS}", "a || ' ' || c", "'list<' || a")
RIGHT = _sql_by("(n0 // 6)", 6, "b", "upper(left(b, 1)) || substr(b, 2)", "left(b, 3)", "'- ' || b", "'Mandatory ' || b", "b || ' ' || d || '>'")


def _left():
    a, b, c, d = (F.col(x) for x in "abcd")
    n, m = F.col("n0"), F.floor(F.col("n0") / 6)
    capital = lambda x: C(F.upper(F.left(x, lit(1))), F.substring(x, 2, 1000))
    left = _by(n, 6, a, C(c, capital(a)), C(a, lit(":")), C(a, (n % 10).cast("string")), C(a, lit(" "), c), C(lit("list<"), a))
    right = _by(m, 6, b, capital(b), F.left(b, lit(3)), C(lit("- "), b), C(lit("Mandatory "), b), C(b, lit(" "), d, lit(">")))
    return left, right


@query(f"""WITH {FOUR}, p AS (SELECT doc_id, n0, trim({LEFT}) AS l, trim({RIGHT}) AS r FROM four), q AS (SELECT *, regexp_extract(l, '(\\S+)$', 1) AS t, regexp_extract(r, '^(\\S+)', 1) AS h FROM p WHERE l <> '' AND r <> ''),
k AS (SELECT *, regexp_matches(right(t, 1), '[A-Za-z0-9<>/]') AND regexp_matches(left(h, 1), '[A-Za-z0-9<>/]') AS meet, lower(t) NOT IN {CONNECTORS} AS free, regexp_matches(left(h, 1), '[a-z]') AS small, regexp_matches(t || h, '[a-z][A-Z]') AS hump FROM q)
SELECT doc_id, n0, l || CASE WHEN NOT meet THEN {NL} WHEN free AND (contains(t || h, '<') OR contains(t || h, '>')) THEN '' WHEN free AND small AND hump THEN ''
 WHEN free AND regexp_matches(right(t, 1), '[a-z]') AND regexp_matches(left(h, 1), '[A-Z]') AND l = t AND r = h AND lower(h) NOT IN {CONNECTORS} AND length(t || h) <= 35 THEN ''
 WHEN free AND small AND ((length(t) >= 3 AND length(h) <= 4) OR (length(t) = 1 AND regexp_matches(t, '[A-Za-z]'))) THEN '' WHEN regexp_matches(l, '[:;?]$') OR regexp_matches(r, '(?i)^(Format|Mandatory|Optional|Example|Allowed)') OR regexp_matches(r, '^[-*•]')
 OR (regexp_matches(l, '[0-9]$') AND regexp_matches(r, '^[A-Z]')) THEN {NL} ELSE ' ' END || r AS cell FROM k""")
def str_cell_seams(spark, sf):
    """Two lines of a cell: what stands between them."""
    left, right = (F.trim(x) for x in _left())
    rows = _four(spark, sf).select("doc_id", "n0", left.alias("l"), right.alias("r")).where("l <> '' AND r <> ''")
    return rows.select("doc_id", "n0", cells.clean_cell(C("l", lit(" \r\n\n"), "r")).alias("cell"))


CLAUSED = _sql_by("n0", 5, "'x' || a || ' Allowed: ' || b", "'Format' || chr(10) || 'x' || a", "'Example x' || a || ' y' || b", "'x' || a || ' 1- ' || 'Y' || b", "'x' || a || ' y' || b")
SET_APART = _sql_by("n0", 5, "'x' || a || chr(10) || rtrim('Allowed: ' || b)", "'Format:' || chr(10) || '• x' || a", "'Example: x' || a || ' y' || b", "'x' || a || chr(10) || '1- Y' || b", "'x' || a || ' y' || b")


@query(f"WITH {FOUR} SELECT doc_id, n0, {SET_APART} AS described FROM four WHERE length(a) > 2")
def str_descriptions(spark, sf):
    a, b = F.col("a"), F.col("b")
    raw = _by(F.col("n0"), 5, C(lit("x"), a, lit(" Allowed: "), b), C(lit("Format\nx"), a), C(lit("Example x"), a, lit(" y"), b), C(lit("x"), a, lit(" 1- Y"), b), C(lit("x"), a, lit(" y"), b))
    return _four(spark, sf).where("length(a) > 2").select("doc_id", "n0", cells.clean_description(raw).alias("described"))


@query(f"WITH {FOUR} SELECT doc_id, n0, {_sql_by('n0', 3, chr(39) + 'Objects of x' + chr(39) + ' || a', chr(39) + 'x' + chr(39) + ' || a || ' + chr(39) + ' (Objects of y) Mandatory' + chr(39), chr(39) + 'plain x' + chr(39) + ' || a')} AS title FROM four")
def str_short_titles(spark, sf):
    a = F.col("a")
    raw = _by(F.col("n0"), 3, C(lit("Objects of x"), a, lit(" - Mandatory field")), C(lit("x"), a, lit(" (Objects of y) Mandatory")), C(lit("plain x"), a))
    return _four(spark, sf).select("doc_id", "n0", cells.short_title(raw).alias("title"))


HEADED = _sql_by("n0", 4, "['Parameter', 'Mandatory', 'Data type', 'Remarks']", "['x' || a, 'Y', 'string', 'x']", "['x' || a, 'y', 'z', 'q']", "['x' || a, 'Description']")


@query(f"""WITH {FOUR}, r AS (SELECT doc_id, n0, a, b, {HEADED} AS h FROM four)
SELECT doc_id, n0, array_to_string(CASE WHEN n0 % 4 IN (0, 1) OR (n0 % 4 = 2 AND n0 % 8 = 2) THEN ['Field', 'Required', 'Type', 'Description'] ELSE h END, '|') AS headers, {_sql_by("n0", 4, "'x' || a || '|N|x|y'", "'x' || a || '|N|x|y'", "CASE WHEN n0 % 8 = 2 THEN 'x|O|list<x>|y' ELSE 'x' || a || '|N|x|y' END", "'x' || a || '|Format:' || chr(10) || '• x' || b")} AS row FROM r""")
def str_table_cells(spark, sf):
    """Headers and rows: parameter tables get the usual names, a repeated header row goes, descriptions are set in lines."""
    a, b, n = F.col("a"), F.col("b"), F.col("n0")
    xa = C(lit("x"), a)
    headers = _by(n, 4, F.array(lit("Parameter"), lit("Mandatory"), lit("Data type"), lit("Remarks")), F.array(xa, lit("Y"), lit("string"), lit("x")), F.array(xa, lit("y"), lit("z"), lit("q")), F.array(xa, lit("Description")))
    usual = F.array(xa, lit("N"), lit("x"), lit("y"))
    flat = _by(n, 4, usual, usual, F.when(n % 8 == 2, F.array(lit("x"), lit("O"), lit("list<x>"), lit("y"))).otherwise(usual), F.array(xa, C(lit("Format\nx"), b)))
    rows = _four(spark, sf).select("doc_id", "n0", headers.alias("h"), flat.alias("r"))
    named = rows.withColumn("names", cells.clean_headers(F.col("h"), F.col("r")))
    clean = cells.clean_rows(F.col("names"), F.array("names", "r"))
    return named.select("doc_id", "n0", F.array_join("names", "|").alias("headers"), F.array_join(F.get(clean, lit(0)), "|").alias("row"))


# ---- tables
def _nested(spark, sf):
    """A table of each document: a line is a row, each fifth opens a section."""
    a, b = F.col("a"), F.col("b")
    row = F.when(F.col("n0") % 5 == 2, F.array(C(lit("Objects of x"), a), lit(""), lit(""))).otherwise(F.array(C(lit("x"), a), C(lit("y"), b), lit("z")))
    one = F.struct("n0", row.alias("r"))
    rows = _four(spark, sf).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["r"]).alias("rows"))
    return rows.select("doc_id", lit(1).alias("page"), lit(1).alias("ordinal"), F.array(lit("Field"), lit("Kind"), lit("Note")).alias("headers"), "rows", lit("| Objects of |").alias("markdown"))


SECTIONED = f"{FOUR}, s AS (SELECT *, n0 % 5 = 2 AS title, sum(CASE WHEN n0 % 5 = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n0) AS raw FROM four), f AS (SELECT doc_id, raw, max(CASE WHEN title THEN 'Objects of x' || a END) AS section_title, count(*) FILTER (NOT title) AS n FROM s GROUP BY doc_id, raw), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS child FROM f WHERE raw > 0 AND n > 0)"


@query(f"WITH {SECTIONED} SELECT doc_id, 'p0001-t01' AS parent, 'p0001-t01-c' || lpad(CAST(child AS VARCHAR), 2, '0') AS child, section_title FROM k")
def jn_parent_child(spark, sf):
    n = cut(tables.nodes(_nested(spark, sf)))
    child = n.where("table_role = 'child'").select("doc_id", "parent_table_id", F.col("table_id").alias("child"), "section_title")
    return n.where("table_role = 'parent'").select("doc_id", F.col("table_id").alias("parent_table_id")).join(child, ["doc_id", "parent_table_id"]).select("doc_id", F.col("parent_table_id").alias("parent"), "child", "section_title")


@query(f"WITH {SECTIONED} SELECT s.doc_id, 'p0001-t01-c' || lpad(CAST(child AS VARCHAR), 2, '0') AS table_id, row_number() OVER (PARTITION BY s.doc_id, child ORDER BY n0) AS row_number, 'x' || a || '|y' || b || '|z' AS row FROM s JOIN k ON k.doc_id = s.doc_id AND k.raw = s.raw WHERE NOT title")
def fld_nested_sections(spark, sf):
    n = tables.nodes(_nested(spark, sf)).where("table_role = 'child'")
    return n.select("doc_id", "table_id", F.posexplode("rows").alias("i", "r")).select("doc_id", "table_id", (F.col("i") + 1).cast("long").alias("row_number"), F.array_join("r", "|").alias("row"))


CHAINED = f"""{FOUR}, p AS (SELECT *, CAST(n0 + 1 AS INTEGER) AS page, n0 % 3 <> 2 AS low, n0 % 4 <> 3 AS high, n0 % 5 = 4 AS over FROM four),
e AS (SELECT *, coalesce(high AND lag(low) OVER (PARTITION BY doc_id ORDER BY page), FALSE) AS taken FROM p), c AS (SELECT *, sum(CASE WHEN taken THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY page) AS chain FROM e)"""


def _crossing(spark, sf):
    """Each line a page with one table: at the bottom of the page or not, at its top or not, some with a row that overflows."""
    n, a, b = F.col("n0"), F.col("a"), F.col("b")
    box = F.array(lit(50.0), F.when(n % 4 != 3, 50.0).otherwise(300.0), lit(550.0), F.when(n % 3 != 2, 950.0).otherwise(600.0))
    first = F.when(n % 5 == 4, F.array(lit(""), C(lit("o"), b))).otherwise(F.array(C(lit("x"), a), C(lit("y"), b)))
    snapshot = F.struct(box, F.array(lit("Name"), lit("Value")), F.array(first, F.array(C(lit("p"), a), lit("q"))), lit("| Name |"), lit(None).cast("boolean"), lit(None).cast("int")).cast(SNAPSHOT)
    return _four(spark, sf).select(F.col("doc_id").cast("string").alias("slice_file"), (n + 1).cast("int").alias("page"), lit(1000.0).alias("height"), F.array(snapshot).alias("tables"))


@query(f"""WITH {CHAINED}, t AS (SELECT doc_id, chain, min(page) AS page, count(*) AS n, string_agg(CASE WHEN over AND taken THEN chr(10) || 'o' || b WHEN over THEN '/|o' || b ELSE '/x' || a || '|y' || b END || '/p' || a || '|q', '' ORDER BY page) AS s FROM c GROUP BY doc_id, chain)
SELECT CAST(doc_id AS VARCHAR) AS slice_file, page, substr(s, 2) AS rows, CAST(n AS INTEGER) AS chain FROM t""")
def fld_cross_page_tables(spark, sf):
    out = tables.merged_across_pages(_crossing(spark, sf))
    return out.select("slice_file", "page", F.explode("tables").alias("t")).select("slice_file", "page", F.array_join(F.transform("t.rows", lambda r: F.array_join(r, "|")), "/").alias("rows"), F.coalesce("t.cross_page_count", lit(1)).alias("chain"))


OVER = "[CASE WHEN n0 % 2 = 0 THEN '' ELSE a END, CASE WHEN n0 % 3 = 0 THEN ' ' ELSE b END, CASE WHEN n0 % 5 < 3 THEN '' ELSE c END]"


@query(f"WITH {FOUR}, r AS (SELECT doc_id, n0, {OVER} AS r FROM four) SELECT doc_id, n0, len(list_filter(r, lambda x: trim(x) <> '')) = 0 OR (len(list_filter(r, lambda x: trim(x) <> '')) = 1 AND trim(r[1]) = '') AS overflows FROM r")
def prd_overflow_row(spark, sf):
    n = F.col("n0")
    row = F.array(F.when(n % 2 == 0, "").otherwise(F.col("a")), F.when(n % 3 == 0, " ").otherwise(F.col("b")), F.when(n % 5 < 3, "").otherwise(F.col("c")))
    return _four(spark, sf).select("doc_id", "n0", tables.is_overflow_row(row).alias("overflows"))


@query(f"WITH {FOUR} SELECT doc_id, CAST(n0 AS INTEGER) AS page FROM four WHERE n0 % 3 <> 0 AND n0 % 4 <> 1")
def prd_retry_pages(spark, sf):
    n = F.col("n0")
    snapshots = F.when(n % 3 == 0, F.when(n % 2 == 0, F.array().cast("array<string>"))).otherwise(F.array(F.col("a")))
    return tables.retry_pages(_four(spark, sf).select("doc_id", n.cast("int").alias("page"), snapshots.alias("tables"), F.when(n % 4 == 1, C(lit("| "), "a", lit(" |\n|  ---|"))).when(n % 4 == 2, "a").alias("text")), ["doc_id"])


BROKEN = _sql_by("n0", 4, "'| ab' || a || '<br>c' || b || ' | d |'", "'| ' || left(b, 2) || ' | ' || left(c, 1) || ' |'", "'| ' || a || ' | ' || a || ' |'", "a || ' <br> ' || b")


@query(f"WITH {FOUR}, m AS (SELECT doc_id, n0, {BROKEN} AS m FROM four) SELECT doc_id, n0, regexp_matches(m, '[A-Za-z]{{2,}}<br>[A-Za-z]') OR (starts_with(m, '|') AND len(list_filter(list_transform(string_split(m, '|'), lambda c: trim(c)), lambda c: regexp_matches(c, '^[a-z].?$'))) >= 2) AS corrupted FROM m")
def prd_corrupted_table(spark, sf):
    a, b, c = (F.col(x) for x in "abc")
    md = _by(F.col("n0"), 4, C(lit("| ab"), a, lit("<br>c"), b, lit(" | d |")), C(lit("| "), F.left(b, lit(2)), lit(" | "), F.left(c, lit(1)), lit(" |")), C(lit("| "), a, lit(" | "), a, lit(" |")), C(a, lit(" <br> "), b))
    return _four(spark, sf).select("doc_id", "n0", T.is_corrupted_table(md).alias("corrupted"))


BAD = "'| ab<br>c' || a || ' | ab<br>d |' || chr(10) || '|---|---|' || chr(10) || '| x | y |'"
GOOD = "'| ' || a || ' | t |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |'"
GONE = f"'{tables.PLACEHOLDER}'"


@query(f"WITH {FOUR} SELECT doc_id, n0, {_sql_by('n0', 4, f'rtrim(trim(line) || {NL} || {NL} || {GONE} || {NL} || {NL} || trim(line))', GOOD, GONE, 'trim(line)')} AS text, CASE WHEN n0 % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS suppressed FROM four WHERE trim(line) <> ''")
def fld_sanitized_pages(spark, sf):
    """Broken pipe tables become a placeholder, with blank lines around it where text is near."""
    bad = C(lit("| ab<br>c"), "a", lit(" | ab<br>d |\n|---|---|\n| x | y |"))
    good = C(lit("| "), "a", lit(" | t |\n|---|---|\n| 1 | 2 |"))
    text = _by(F.col("n0"), 4, C(F.trim("line"), lit("\n"), bad, lit("\n"), F.trim("line")), good, bad, F.trim("line"))
    return tables.sanitized(_four(spark, sf).where("trim(line) <> ''").select("doc_id", "n0", text.alias("text")), ["doc_id", "n0"])


SHOWN = _sql_by("n0", 6, "'| xyz' || a || ' | yes |' || chr(10) || '|---|---|'", "'![Table](i.png)'", "'| A' || a || ' |' || chr(10) || '| --- |' || chr(10) || '| ' || b || ' |'", "'<p>' || a || '</p>'", "'![Table](j.png)'", "NULL")
FIX = _sql_by("n0", 6, "NULL", "'table_fallback_image_applied'", "'table_rebuilt'", "'table_fallback_html_applied'", "'table_fallback_image_applied'", "NULL")


@query(f"WITH {FOUR} SELECT doc_id, n0, {SHOWN} AS markdown, {FIX} AS fix FROM four")
def str_table_forms(spark, sf):
    a, b, n = F.col("a"), F.col("b"), F.col("n0")
    md = F.when(n % 6 == 0, C(lit(" |xyz"), a, lit("|  yes |\n|---|---|"))).when(n % 6 == 1, C(lit("| ab"), a, lit("<br>cd |"))).when(n % 6 == 2, "").when(n % 6 == 3, " ")
    none = F.array().cast("array<string>")
    t = F.struct(md.alias("markdown"), F.when(n % 6 == 2, F.array(C(lit("A"), a))).when(n % 6 == 3, none).alias("headers"), F.when(n % 6 == 2, F.array(F.array(b))).alias("rows"), F.when(n % 6 == 3, C(lit(" <p>"), a, lit("</p>\n"))).alias("fallback_html"), F.when(n % 6 == 1, "i.png").when(n % 6 == 4, "j.png").alias("fallback_image"))
    return _four(spark, sf).select("doc_id", "n0", tables.table_markdown(t).alias("m")).select("doc_id", "n0", "m.markdown", "m.fix")


JOINED = _sql_by("n0", 4, "a || 'A' || b || ' ' || c", "a || ' ' || upper(left(b, 1)) || substr(b, 2)", "a || ' ' || b", "a || ' ' || b || ' ' || c")
COMMON = "('a','an','the','this','that','these','those','is','are','was','were','be','been','being','have','has','had','do','does','did','will','would','shall','should','may','might','can','could','not','no','or','and','but','if','of','at','by','for','in','on','to','with','from','as','all','each','every','any','some','its','per')"


@query(f"""WITH {FOUR}, t AS (SELECT doc_id, n0, {JOINED} AS t FROM four), p AS (SELECT *, list_filter(string_split(t, ' '), lambda x: x <> '') AS ps FROM t)
SELECT doc_id, n0, CASE WHEN len(ps) = 2 AND length(ps[1] || ps[2]) <= 35 AND regexp_matches(ps[1] || ps[2], '[a-z][A-Z]') AND (regexp_matches(ps[2], '^[a-z]') OR (regexp_matches(ps[2], '^[A-Z]') AND ps[1] = lower(ps[1]) AND ps[1] NOT IN {COMMON})) THEN ps[1] || ps[2] ELSE t END AS text FROM p""")
def str_rejoined(spark, sf):
    a, b, c = (F.col(x) for x in "abc")
    t = _by(F.col("n0"), 4, C(a, lit("A"), b, lit(" "), c), C(a, lit(" "), F.upper(F.left(b, lit(1))), F.substring(b, 2, 1000)), C(a, lit(" "), b), C(a, lit(" "), b, lit(" "), c))
    return _four(spark, sf).select("doc_id", "n0", T.rejoin(t).alias("text"))


@query(f"""WITH {FOUR} SELECT doc_id, n0, {_sql_by("n0", 4, "'## H' || a || chr(10) || chr(10) || '- i' || b || chr(10) || chr(10) || '<t/>'", "'p' || a || ' <t/> q' || b", "'p' || a || chr(10) || chr(10) || '<t/>'", "'![S' || a || '](f.png)'")} AS markdown FROM four""")
def str_pages_rendered(spark, sf):
    """Page Markdown with its complex tables: rebuilt from blocks, in the place of the placeholder, at the end, as an image."""
    from quire.schemas import PAGE

    a, b, n = F.col("a"), F.col("b"), F.col("n0")
    block = lambda kind, text, order: F.struct(lit(kind), text, lit(1), lit(None).cast("array<double>"), lit(order), lit(False), lit(None).cast("string"), lit(None).cast("int"))
    blocks = F.array(block("heading", C(lit("H"), a), 1), block("header", lit("skip"), 2), block("list_item", C(lit(" i"), b), 3))
    title, html, image = F.when(n % 4 == 3, C(lit("S"), a)), F.when(n % 4 != 3, lit(" <t/> ")), F.when(n % 4 == 3, "f.png")
    table = lambda role, rows: F.struct(lit("t"), F.array().cast("array<string>"), rows, lit(None).cast("string"), html, image, lit(None).cast("array<double>"), lit(None).cast("string"), lit(role), title, F.array().cast("array<string>"))
    none = F.array().cast("array<array<string>>")
    shown = F.array(table("parent", none), table("standalone", F.array(F.array(lit("x")))))
    md = F.when(n % 4 == 1, C(lit("p"), a, lit(f" {tables.PLACEHOLDER} q"), b)).when(n % 4 == 2, C(lit("p"), a)).when(n % 4 == 3, lit(tables.PLACEHOLDER)).otherwise(" ")
    page = F.struct(lit(1), lit(1), lit(False), md, blocks, shown, F.array().cast("array<struct<a:string>>")).cast(PAGE.replace("images:array<struct<asset_path:string,caption:string,bbox:array<double>,width:int,height:int>>", "images:array<struct<a:string>>"))
    return _four(spark, sf).select("doc_id", "n0", tables.page_markdown(page).alias("markdown"))


HOLDER = f"'{tables.PLACEHOLDER}'"


@query(f"""WITH {FOUR} SELECT doc_id, n0, {_sql_by("n0", 4, "'a' || a || chr(10) || '<t' || b || '>' || chr(10) || 'z'", "'<t' || b || '> x' || chr(10) || chr(10) || '<u>' || chr(10) || chr(10) || '<v>'", "'plain' || a", "'<t' || b || '>' || chr(10) || chr(10) || '<u>'")} AS markdown FROM four""")
def str_placeholder_fill(spark, sf):
    a, b, p = F.col("a"), F.col("b"), tables.PLACEHOLDER
    t = C(lit("<t"), b, lit(">"))
    md = _by(F.col("n0"), 4, C(lit("a"), a, lit(f"\n{p}\nz{p}")), lit(f"{p} x"), C(lit("plain"), a), lit(""))
    parts = _by(F.col("n0"), 4, F.array(t), F.array(t, lit("<u>"), lit("<v>")), F.array().cast("array<string>"), F.array(t, lit("<u>")))
    return _four(spark, sf).select("doc_id", "n0", tables.filled_placeholders(md, parts).alias("markdown"))


# ---- repairs
def _rows(spark, sf, kind, text):
    """Blocks of one document a line: doc_id, page, rn, reading_order, block_type, markdown, node_ref, ..."""
    rows = _four(spark, sf).select("doc_id", (F.floor(F.col("n0") / 5) + 1).cast("int").alias("page"), (F.col("n0") + 1).alias("rn"), F.col("n0").alias("reading_order"), kind.alias("block_type"), text.alias("markdown"), C(lit("r"), (F.col("n0") % 7).cast("string")).alias("node_ref"), (F.col("n0") < 5).alias("is_overlap"), "n0", "a", "b")
    return rows.withColumns({"repaired": lit(False), "repair_actions": F.array().cast("array<string>")})


REBUILT = _sql_by("n0", 5, "'```' || chr(10) || 'x' || a || chr(10) || '```'", "'- x' || a", "'| x' || a || ' | b |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | 2 |'", "CASE WHEN n0 % 2 = 1 THEN '![Cat](p.png)' ELSE '![image](p.png)' END", "'x' || a")


@query(f"WITH {FOUR} SELECT doc_id, n0 + 1 AS rn, {REBUILT} AS markdown, {_sql_by('n0', 5, chr(39) + 'code_fence_closed' + chr(39), 'CASE WHEN n0 % 2 = 0 THEN ' + chr(39) + chr(39) + ' ELSE ' + chr(39) + 'list_rebuilt' + chr(39) + ' END', chr(39) + 'table_separator_inserted' + chr(39), 'CASE WHEN n0 % 2 = 1 THEN ' + chr(39) + 'image_caption_filled' + chr(39) + ' ELSE ' + chr(39) + chr(39) + ' END', chr(39) + chr(39))} AS actions FROM four")
def str_structure(spark, sf):
    n, xa = F.col("n0"), C(lit("x"), "a")
    kind = _by(n, 5, lit("code"), lit("list_item"), lit("table"), lit("image"), lit("paragraph"))
    text = _by(n, 5, C(lit("```\n"), xa), F.when(n % 2 == 0, C(lit("- "), xa)).otherwise(xa), C(lit("| "), xa, lit(" | b |\n| 1 | 2 |")), lit("![image](p.png)"), xa)
    rows = _rows(spark, sf, kind, text).withColumn("node_ref", F.col("n0").cast("string"))
    captions = rows.where("n0 % 2 = 1").select("doc_id", "node_ref", lit("Cat").alias("caption"))
    return repair.structure(rows, captions).select("doc_id", "rn", "markdown", F.array_join("repair_actions", ",").alias("actions"))


@query(f"""WITH {FOUR}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n0 % 7 ORDER BY n0) = 1 AS first FROM four)
SELECT doc_id, n0 + 1 AS rn, array_to_string(list_concat(CASE WHEN first AND n0 % 7 = 1 THEN ['missing_block_restored'] ELSE [] END, list_concat(CASE WHEN first AND n0 % 7 = 2 THEN ['image_reference_restored'] ELSE [] END, CASE WHEN n0 // 5 = 1 THEN ['overlap_block_restored'] ELSE [] END)), ',') AS actions FROM k""")
def str_restored(spark, sf):
    rows = _rows(spark, sf, lit("paragraph"), C(lit("x"), "a"))
    d = rows.select("doc_id").distinct()
    miss = lambda ref, kind, page: d.select("doc_id", lit(ref).cast("string").alias("node_ref"), lit(kind).alias("issue_type"), lit(page).cast("int").alias("page"))
    missing = miss("r1", "missing_block", None).unionByName(miss("r2", "image_reference_missing", None)).unionByName(miss(None, "overlap_lost", 2))
    return repair.restored(rows, missing).select("doc_id", "rn", F.array_join("repair_actions", ",").alias("actions"))


@query(f"""WITH RECURSIVE {FOUR}, h AS (SELECT doc_id, n0, CAST(length(a) % 6 + 1 AS INTEGER) AS level, row_number() OVER (PARTITION BY doc_id ORDER BY n0) AS k FROM four WHERE n0 % 3 = 0),
f AS (SELECT doc_id, n0, k, level, level AS fixed FROM h WHERE k = 1 UNION ALL SELECT h.doc_id, h.n0, h.k, h.level, least(h.level, f.fixed + 1) FROM f JOIN h ON h.doc_id = f.doc_id AND h.k = f.k + 1)
SELECT four.doc_id, four.n0 + 1 AS rn, CASE WHEN f.k IS NULL THEN 'x' || a ELSE repeat('#', fixed) || ' x' || a END AS markdown, coalesce(fixed < level, FALSE) AS repaired FROM four LEFT JOIN f ON f.doc_id = four.doc_id AND f.n0 = four.n0""")
def fld_heading_levels(spark, sf):
    n, xa = F.col("n0"), C(lit("x"), "a")
    rows = _rows(spark, sf, F.when(n % 3 == 0, "heading").otherwise("paragraph"), F.when(n % 3 == 0, C(F.repeat(lit("#"), (F.length("a") % 6 + 1).cast("int")), lit(" "), xa)).otherwise(xa))
    return repair.heading_levels(rows).select("doc_id", "rn", "markdown", "repaired")


@query(f"""WITH {FOUR}, d AS (SELECT doc_id, 'x' || arg_max(a, n0) AS title, max(n0) AS n FROM four GROUP BY doc_id), r AS (SELECT four.*, title, n, n0 % 4 = 1 AS head, CASE WHEN n0 % 4 = 1 THEN CASE WHEN doc_id % 3 = 0 AND n0 = 1 THEN '# x' ELSE '## x' END ELSE 'x' END || a AS md FROM four JOIN d USING (doc_id)),
k AS (SELECT *, max(doc_id % 3 = 0 AND n0 = 1) OVER w AS has, min(CASE WHEN head AND 'x' || a = title THEN n0 END) OVER w AS like_, coalesce(min(CASE WHEN n0 >= 5 THEN n0 // 5 END) OVER w, 0) AS target FROM r WINDOW w AS (PARTITION BY doc_id)),
o AS (SELECT doc_id, n0 + 1.0 AS o, CASE WHEN NOT has AND n0 = like_ THEN '# x' || a ELSE md END AS markdown, NOT has AND like_ IS NOT NULL AND n0 = like_ AS repaired FROM k
 UNION ALL SELECT doc_id, min(n0) + 0.5, '# ' || any_value(title), TRUE FROM k WHERE NOT has AND like_ IS NULL AND n0 // 5 = target GROUP BY doc_id)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY o) AS INTEGER) AS rn, markdown, repaired FROM o""")
def win_top_heading(spark, sf):
    n, xa = F.col("n0"), C(lit("x"), "a")
    head = n % 4 == 1
    top = (F.col("doc_id") % 3 == 0) & (n == 1)
    base = _four(spark, sf)
    rows = base.select("doc_id", (F.floor(n / 5) + 1).cast("int").alias("page"), (n + 1).alias("rn"), n.alias("reading_order"), F.when(head, "heading").otherwise("paragraph").alias("block_type"), F.when(head, C(F.when(top, "# ").otherwise("## "), xa)).otherwise(xa).alias("markdown"), lit("r").alias("node_ref"), (n < 5).alias("is_overlap"), lit(False).alias("repaired"), F.array().cast("array<string>").alias("repair_actions"))
    titles = base.groupBy("doc_id").agg(C(lit("x"), F.max_by("a", "n0")).alias("display_title"))
    return repair.top_heading(rows, titles).select("doc_id", "rn", "markdown", "repaired")


KINDS = ["heading", "image", "table", "paragraph", "quote", "code", "list_item"]


@query(f"""WITH {FOUR}, o AS (SELECT doc_id, n0, CAST(n0 // 8 AS INTEGER) AS page, length(a) % 3 AS reading_order, ['heading', 'image', 'table', 'paragraph', 'quote', 'code', 'list_item'][CAST(n0 % 7 AS INTEGER) + 1] AS kind FROM four)
SELECT doc_id, n0, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, reading_order, CASE kind WHEN 'heading' THEN 0 WHEN 'paragraph' THEN 1 WHEN 'list_item' THEN 2 WHEN 'code' THEN 3 WHEN 'table' THEN 4 WHEN 'image' THEN 5 ELSE 99 END, n0) AS INTEGER) AS rn FROM o""")
def srt_block_order(spark, sf):
    n = F.col("n0")
    rows = _four(spark, sf).select("doc_id", "n0", F.floor(n / 8).cast("int").alias("page"), (F.length("a") % 3).alias("reading_order"), F.get(F.array(*map(lit, KINDS)), (n % 7).cast("int")).alias("block_type"), n.alias("ordinal"))
    return repair.ordered(rows).select("doc_id", "n0", "rn")


@query(f"WITH {FOUR}, h AS (SELECT doc_id, n0, CAST(n0 % 4 + 1 AS INTEGER) AS level, 'x' || left(a, 1) AS norm FROM four WHERE n0 % 3 <> 1) SELECT doc_id, norm, arg_max(level, n0) AS draft_level FROM h GROUP BY doc_id, norm")
def jn_draft_levels(spark, sf):
    n = F.col("n0")
    line = F.when(n % 3 == 1, C(lit("x"), F.left("a", lit(1)))).otherwise(C(lit(" "), F.repeat(lit("#"), (n % 4 + 1).cast("int")), lit("  x"), F.left("a", lit(1)), lit(" ")))
    drafts = _four(spark, sf).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n0", line.alias("l")))), lambda x: x["l"]), "\n").alias("markdown"))
    return phases.draft_levels(drafts).select("doc_id", "norm", "draft_level")


# ---- alignment
@query("""WITH d AS (SELECT doc_id, doc_id % 5 = 0 AS piped, doc_id % 5 = 1 AS named, doc_id % 5 = 2 AS shown, doc_id % 3 = 0 AS html FROM documents)
SELECT doc_id, piped OR named OR (shown AND html) AS matched, named OR (shown AND html) AS strictly FROM d""")
def jn_tables_matched(spark, sf):
    d = F.col("doc_id")
    docs = _docs(spark, sf)
    t = docs.select("doc_id", lit("table:1:0").alias("node_ref"), lit("p0001-t01").alias("table_id"), F.when(d % 3 == 0, "<div>").when(d % 3 == 1, "").alias("fallback_html"))
    s = docs.where("doc_id % 5 < 4").select("doc_id", _by(d, 5, lit("table"), lit("html_block"), lit("html_block"), lit("paragraph"), lit("")).alias("segment_type"), _by(d, 5, lit("| a |"), lit("<div id='p0001-t01'>"), lit("<div class='complex-table-block'>"), lit("p0001-t01"), lit("")).alias("text"))
    both = align.matched_tables(t, s).join(align.matched_tables(t, s, strict=True).select("doc_id", F.col("matched").alias("strictly")), "doc_id")
    return both.select("doc_id", "matched", "strictly")


@query("SELECT doc_id, doc_id % 4 IN (0, 1, 2) AND doc_id % 7 <> 0 AS matched FROM documents")
def jn_images_matched(spark, sf):
    d = F.col("doc_id")
    docs = _docs(spark, sf)
    images = docs.select("doc_id", lit("image:1:0").alias("node_ref"), F.when(d % 7 == 0, F.when(d % 2 == 0, "")).otherwise("assets/p.png").alias("asset_path"))
    s = docs.where("doc_id % 4 < 2").select("doc_id", lit("image").alias("segment_type"), F.when(d % 4 == 0, "assets/p.png").otherwise("../x/assets/p.png?y").alias("text"))
    drafts = docs.select("doc_id", F.when(d % 4 == 2, "see (assets/p.png)").otherwise("nothing").alias("markdown"))
    return align.matched_images(images, s, drafts).select("doc_id", "matched")


@query(f"""WITH {FOUR}, p AS (SELECT doc_id, CAST(n0 AS INTEGER) AS source_page, n0 % 2 = 0 AS o, {_sql_by("n0", 3, "NULL", "' ' || chr(10)", "a")} AS m FROM four) SELECT doc_id, source_page, 'overlap_lost' AS issue_type FROM p WHERE o AND trim(coalesce(m, ''), ' ' || chr(10)) = ''""")
def jn_overlap_lost(spark, sf):
    n = F.col("n0")
    rows = _four(spark, sf).select("doc_id", n.cast("int").alias("source_page"), (n % 2 == 0).alias("is_overlap"), F.when(n % 3 == 1, " \n").when(n % 3 == 2, F.col("a")).alias("markdown"))
    return align.overlap_issues(rows).select("doc_id", "source_page", "issue_type")


@query(f"""WITH {FOUR} SELECT doc_id, n0, n0 % 3 = 0 AND n0 % 2 = 0 AND n0 % 5 < 2 AS opens FROM four""")
def prd_chapter_heading(spark, sf):
    n = F.col("n0")
    md = C(F.repeat(lit("#"), (n % 5 + 1).cast("int")), lit(" x"), "a")
    return _four(spark, sf).select("doc_id", "n0", merge.opens_chapter(F.when(n % 3 == 0, "heading").otherwise("paragraph"), n % 2, lit(0), md).alias("opens"))


# ---- Markdown
def _draft(spark, sf):
    """Markdown of each document: by turns a heading, a paragraph, a list, a fence, an image and a table a line."""
    n, xa = F.col("n0"), C(lit("x"), "a")
    part = _by(n, 6, C(lit("## "), xa), C(xa, lit("\n  y"), "b"), C(lit("* "), xa, lit("\n* y"), "b"), C(lit("```py\n"), xa, lit("\n```")), C(lit("![alt](x"), "a", lit(".png)")), C(lit("|"), xa, lit("|y|\n|--|:-:|\n|1|2|")))
    rows = _four(spark, sf).select("doc_id", "n0", part.alias("p"))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n0", "p"))), lambda x: x["p"]), "\n\n").alias("markdown"))


PARTS = ["'## x' || a", "'x' || a || chr(10) || '  y' || b", "'* x' || a || chr(10) || '* y' || b", "'```py' || chr(10) || 'x' || a || chr(10) || '```'", "'![alt](x' || a || '.png)'", "'|x' || a || '|y|' || chr(10) || '|--|:-:|' || chr(10) || '|1|2|'"]


@query(f"""WITH {FOUR}, p AS (SELECT doc_id, n0, {_sql_by("n0", 6, *PARTS)} AS p, 'x' || a || '.png' AS image FROM four)
SELECT doc_id, CAST(n0 + 1 AS INTEGER) AS ordinal, {_sql_by("n0", 6, "'heading'", "'paragraph'", "'paragraph'", "'code'", "'image'", "'table'")} AS block_type, CASE WHEN n0 % 6 = 4 THEN image END AS asset_ref, sha256(trim(regexp_replace(p, '\\s+', ' ', 'g'))) AS normalized_text_hash FROM p""")
def str_blocks_markdown(spark, sf):
    return markdown.references(_draft(spark, sf), ["doc_id"]).select("doc_id", "ordinal", "block_type", "asset_ref", "normalized_text_hash")


@query(f"""WITH {FOUR}, s AS (SELECT doc_id, n0, 0 AS k, {_sql_by("n0", 6, "'heading'", "'paragraph'", "'list'", "'code'", "'image'", "'table'")} AS segment_type, {_sql_by("n0", 6, "'x' || a", "'x' || a || chr(10) || 'y' || b", "'x' || a || chr(10) || 'y' || b", "'x' || a || chr(10)", "'x' || a || '.png'", PARTS[5])} AS text FROM four
 UNION ALL SELECT doc_id, n0, 1, 'paragraph', 'x' || a FROM four WHERE n0 % 6 = 2 UNION ALL SELECT doc_id, n0, 2, 'paragraph', 'y' || b FROM four WHERE n0 % 6 = 2)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n0, k) AS INTEGER) AS ordinal, segment_type, text FROM s""")
def str_segments_markdown(spark, sf):
    return markdown.segments(_draft(spark, sf), ["doc_id"]).select("doc_id", "ordinal", "segment_type", "text")


@query(f"""WITH {FOUR} SELECT doc_id, string_agg({_sql_by("n0", 6, PARTS[0], "'x' || a || chr(10) || 'y' || b", "'- x' || a || chr(10) || '- y' || b", PARTS[3], PARTS[4], "'| x' || a || ' | y |' || chr(10) || '| --- | :---: |' || chr(10) || '| 1 | 2 |'")}, chr(10) || chr(10) ORDER BY n0) || chr(10) AS markdown FROM four GROUP BY doc_id""")
def str_normalize_markdown(spark, sf):
    return _draft(spark, sf).select("doc_id", markdown.normalize_markdown("markdown").alias("markdown"))


# ---- manifests and summaries
def _manifests(spark, sf):
    """A manifest for each source: its documents are slices."""
    d = F.col("doc_id")
    one = F.struct(d.cast("string").alias("slice_file"), _by(d, 3, lit("success"), lit("failed"), lit("success")).alias("status"), F.floor(d / 40).cast("int").alias("order_index"), (d % 2).cast("int").alias("warning_count"), (d % 11 == 0).alias("manual_review_required"), (d % 9).cast("int").alias("start_page"), (d % 7).cast("int").alias("end_page"), F.array((d % 5).cast("int")).alias("overlap_pages"))
    return _docs(spark, sf).groupBy(F.col("source").alias("source_file")).agg(F.array_sort(F.collect_list(F.struct(d, one.alias("s")))).alias("x")).select("source_file", F.transform("x", lambda x: x["s"]).alias("slices"))


@query("SELECT source AS source_file, CAST(doc_id AS VARCHAR) AS slice_file, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS slice_number FROM documents QUALIFY doc_id % 3 <> 1")
def src_manifest_slices(spark, sf):
    return manifests.succeeded(manifests.slices(_manifests(spark, sf))).select("source_file", "slice_file", F.col("slice_number").cast("int").alias("slice_number"))


@query("SELECT source AS source_file, CAST(doc_id // 40 AS INTEGER) AS order_index, 'DUPLICATE_ORDER' AS error_code FROM documents WHERE doc_id % 3 <> 1 GROUP BY source, doc_id // 40 HAVING count(*) > 1")
def src_order_errors(spark, sf):
    return manifests.order_errors(manifests.slices(_manifests(spark, sf)))


@query("""SELECT CAST(doc_id AS VARCHAR) AS slice_file, CASE WHEN doc_id % 9 = 0 THEN 'BAD_START' WHEN doc_id % 7 < doc_id % 9 THEN 'BAD_RANGE' ELSE 'BAD_OVERLAP' END AS error_code FROM documents
WHERE doc_id % 9 = 0 OR doc_id % 7 < doc_id % 9 OR doc_id % 5 < doc_id % 9 OR doc_id % 5 > doc_id % 7""")
def src_manifest_validate(spark, sf):
    return manifests.slice_errors(manifests.slices(_manifests(spark, sf)))


@query("SELECT source AS source_file, 'NO_SUCCESSFUL_SLICE' AS error_code FROM documents GROUP BY source HAVING count(*) FILTER (doc_id % 3 <> 1) = 0 UNION ALL SELECT source || '!', 'NO_SUCCESSFUL_SLICE' FROM documents GROUP BY source")
def src_without_slices(spark, sf):
    m = _manifests(spark, sf)
    empty = m.select(C("source_file", lit("!")).alias("source_file"), F.filter("slices", lambda s: s["status"] == "failed").alias("slices"))
    return manifests.without_slices(m.unionByName(empty))


@query("SELECT source AS source_file, unnest(CASE WHEN length(source) % 2 = 0 THEN ['total_slices', 'slices'] ELSE ['total_slices'] END) AS field FROM documents GROUP BY source")
def set_missing_keys(spark, sf):
    m = _manifests(spark, sf).select("source_file", lit(None).cast("int").alias("total_slices"), F.when(F.length("source_file") % 2 == 1, F.col("slices")).alias("slices"))
    return manifests.missing_keys(m, "format")


@query("SELECT count(*) AS total_slices, count(*) FILTER (doc_id % 3 <> 1) AS success_count, count(*) FILTER (doc_id % 3 = 1) AS failed_count, CAST(0 AS BIGINT) AS skipped_count, CAST(sum(doc_id % 2) AS BIGINT) AS total_warnings, bool_or(doc_id % 11 = 0) AS manual_review_required FROM documents")
def agg_manifest_rollup(spark, sf):
    return manifests.rollup(manifests.slices(_manifests(spark, sf)))


@query("SELECT CAST(doc_id AS VARCHAR) AS slice_file, 'skipped_upstream_failed' AS status FROM documents WHERE doc_id % 3 = 1")
def jn_skipped_anti(spark, sf):
    rows = manifests.slices(_manifests(spark, sf))
    return align.skipped(rows, manifests.succeeded(rows))


@query("SELECT doc_id, greatest(1, n_chars % 3) AS first, greatest(1, doc_id % 4) AS second, greatest(1, n_chars % 3) + greatest(1, doc_id % 4) AS total FROM documents")
def agg_timings(spark, sf):
    rows = _docs(spark, sf).select("doc_id", F.create_map(lit("a"), (F.col("n_chars") % 3).cast("long"), lit("b"), (F.col("doc_id") % 4).cast("long")).alias("stage_timings"))
    return manifests.timings(rows).select("doc_id", F.col("stage_timings")["a"].alias("first"), F.col("stage_timings")["b"].alias("second"), F.col("stage_timings")["total"].alias("total"))


@query(f"""WITH {FOUR}, b AS (SELECT doc_id, count(*) FILTER (n0 % 3 = 0) AS h1, doc_id % 4 + 1 AS n_slices FROM four GROUP BY doc_id)
SELECT doc_id, 'heading_count_mismatch' AS warning_type FROM b WHERE abs(h1 - n_slices) > n_slices * 0.5 UNION ALL SELECT doc_id, 'asset_path_missing' FROM four WHERE n0 % 3 = 1 AND length(a) % 2 = 1 UNION ALL SELECT doc_id + 1000000000, 'slice_missing' FROM documents WHERE doc_id % 10 = 0""")
def chk_merged_books(spark, sf):
    """Headings, assets and empty books; texts differ, so that no neighbours are equal."""
    n = F.col("n0")
    part = _by(n, 3, C(lit("# x"), "a"), C(lit('<img class="z" src="assets/'), n.cast("string"), lit('.png">')), C(lit("y"), n.cast("string")))
    four = _four(spark, sf)
    books = four.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n0", part.alias("p")))), lambda x: x["p"]), "\n\n").alias("markdown")).withColumn("n_slices", (F.col("doc_id") % 4 + 1).cast("int"))
    empty = _docs(spark, sf).where("doc_id % 10 = 0").select((F.col("doc_id") + 1000000000).alias("doc_id"), lit(" \n").alias("markdown"), lit(2).alias("n_slices"))
    assets = four.where("n0 % 3 = 1 AND length(a) % 2 = 0").select("doc_id", C(lit("assets/"), n.cast("string"), lit(".png")).alias("path"))
    return merge.merged_checks(books.unionByName(empty), assets)


@query(f"""WITH {FOUR}, r AS (SELECT doc_id, n0, a FROM four) SELECT count(DISTINCT doc_id) AS books, CAST(sum(n0) FILTER (n0 % 2 = 0) AS BIGINT) AS removed_blocks, count(*) FILTER (n0 % 2 = 0) AS decisions, count(*) FILTER (n0 % 3 = 0) AS warnings, CASE WHEN count(*) FILTER (n0 % 3 = 0 AND a = '') > 0 THEN 'failed' ELSE 'success' END AS status FROM r""")
def agg_merge_summary(spark, sf):
    four = _four(spark, sf)
    decisions = four.where("n0 % 2 = 0").select("doc_id", F.col("n0").alias("removed_count"))
    warnings = four.where("n0 % 3 = 0").select("doc_id", F.when(F.col("a") == "", "slice_missing").otherwise("page_gap").alias("warning_type"))
    return merge.summary(four.select("doc_id").distinct(), decisions, warnings)


@query(f"""WITH {FOUR} SELECT doc_id, n0, '001-' || trim('T' || a || '_', '. ') AS folder, 'x ![p](../001-T' || a || '_/assets/' || b || '.png) <img src="../001-T' || a || '_/assets/q.png"> ![r](other/z.png)' AS markdown FROM four""")
def str_shared_assets(spark, sf):
    """Asset paths that point to the folder of the phase before, where assets are not copied."""
    rows = _four(spark, sf).select("doc_id", "n0", lit(1).alias("order_index"), C(lit("T"), "a", lit("?")).alias("display_title"), C(lit("x ![p](assets/"), "b", lit('.png) <img src="assets/q.png"> ![r](other/z.png)')).alias("markdown"))
    return merge.relinked_to_source(rows).select("doc_id", "n0", "folder", "markdown")


@query(f"""WITH {FOUR}, p AS (SELECT doc_id, n0, CAST(n0 + 1 AS INTEGER) AS page FROM four) SELECT CAST(doc_id AS VARCHAR) AS doc_id, page, kind, node_ref FROM p, LATERAL (SELECT unnest(['block', 'table', 'image']) AS kind) k, LATERAL (SELECT CASE kind WHEN 'block' THEN 'k' || n0 WHEN 'table' THEN 'table:' || page || ':0' ELSE 'image:' || page || ':0' END AS node_ref) r
WHERE (kind = 'block') OR (kind = 'table' AND n0 % 2 = 0) OR (kind = 'image' AND n0 % 3 = 0)""")
def src_provenance(spark, sf):
    """Blocks, tables and images of extracted content, each with its reference."""
    from quire import schemas as S

    n = F.col("n0")
    page = (n + 1).cast("int")
    block = F.struct(lit("paragraph"), F.col("line"), page, lit(None).cast("array<double>"), lit(1), lit(False), C(lit("k"), n.cast("string")), lit(None).cast("int"))
    none = lit(None).cast("string")
    table = F.struct(lit("t"), F.array().cast("array<string>"), F.array().cast("array<array<string>>"), none, none, none, lit(None).cast("array<double>"), none, none, none, F.array().cast("array<string>"))
    image = F.struct(lit("a.png"), none, lit(None).cast("array<double>"), lit(None).cast("int"), lit(None).cast("int"))
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    one = F.struct(page, page, lit(False), lit(""), F.array(block).cast(f"array<{S.BLOCK}>"), F.when(n % 2 == 0, F.array(table).cast(f"array<{S.TABLE}>")).otherwise(empty(S.TABLE)), F.when(n % 3 == 0, F.array(image).cast(f"array<{S.IMAGE}>")).otherwise(empty(S.IMAGE))).cast(S.PAGE)
    content = _four(spark, sf).groupBy(F.col("doc_id").cast("string").alias("slice_file")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n0", one.alias("p")))), lambda x: x["p"]).alias("source_pages"))
    b, t, i, _ = phases.exploded(content)
    rows = b.select("doc_id", "page", lit("block").alias("kind"), F.col("dedupe_key").alias("node_ref"))
    return rows.unionByName(t.select("doc_id", "page", lit("table").alias("kind"), "node_ref")).unionByName(i.select("doc_id", "page", lit("image").alias("kind"), "node_ref"))


# ---- more tables, code, plans and names
WORDY = _sql_by("n0", 5, "['.', ',']", "list_transform(range(13), lambda i: 'c' || i)", "['a', 'b']", "['x' || a, 'b']", "['Name of ' || a]")
CELLS = _sql_by("n0", 5, "['!', '?']", "['x']", "['1', '22']", "['1', 'long' || b]", "['value']")


@query(f"""WITH {FOUR}, t AS (SELECT doc_id, n0, {WORDY} AS h, {CELLS} AS r, CASE WHEN n0 % 2 = 0 THEN 100.0 ELSE 250000.0 END AS area FROM four)
SELECT doc_id, n0, (area < 3000 AND length(regexp_replace(array_to_string(h, ' ') || array_to_string(r, ' '), '[^A-Za-z0-9]', '', 'g')) < 10) OR len(h) > 12 OR (len(list_filter(h, lambda x: length(x) > 1)) = 0 AND len(list_filter(r, lambda x: length(x) > 2)) = 0) AS spurious FROM t""")
def prd_spurious_table(spark, sf):
    n, a, b = F.col("n0"), F.col("a"), F.col("b")
    side = F.when(n % 2 == 0, 10.0).otherwise(500.0)
    headers = _by(n, 5, F.array(lit("."), lit(",")), F.array(*(lit(f"c{i}") for i in range(13))), F.array(lit("a"), lit("b")), F.array(C(lit("x"), a), lit("b")), F.array(C(lit("Name of "), a)))
    rows = _by(n, 5, F.array(lit("!"), lit("?")), F.array(lit("x")), F.array(lit("1"), lit("22")), F.array(lit("1"), C(lit("long"), b)), F.array(lit("value")))
    return _four(spark, sf).select("doc_id", "n0", tables.is_spurious(F.array(lit(0.0), lit(0.0), side, side), headers, F.array(rows)).alias("spurious"))


@query(f"""WITH {FOUR} SELECT doc_id, n0, {_sql_by("n0", 8, "TRUE", "TRUE", "regexp_matches(a || '<br>' || b, '[a-z]{2,}<br>[a-z]')", "TRUE", "length(a) + 3 >= 12", "length(a) + length(b) >= 20", "FALSE", "TRUE")} AS complex FROM four""")
def prd_complex_table(spark, sf):
    """No rows, ragged rows, broken words, a signal, one text throughout, a long cell with a colon, a sound table, numbered headers."""
    n, a, b = F.col("n0"), F.col("a"), F.col("b")
    cell = lambda *xs: F.array(*xs)
    usual = F.array(cell(lit("1"), lit("2")), cell(lit("3"), lit("4")))
    rows = _by(n, 8, F.array().cast("array<array<string>>"), F.array(cell(lit("1"), lit("2")), cell(lit("3"))), usual, usual, F.array(cell(C(lit("wxy"), a), C(lit("wxy"), a))), F.array(cell(C(a, b, F.repeat(lit("y"), 59), lit(":")), lit("z"))), usual, F.array(cell(lit("1"), lit("2")), cell(lit("3"), lit("4")), cell(lit("5"), lit("6"))))
    headers = F.when(n % 8 == 7, F.array(lit("Col1"), lit("Col2"))).otherwise(F.array(lit("A"), lit("B")))
    md = _by(n, 8, lit("| x |"), lit("| x |"), C(a, lit("<br>"), b), C(lit("limits: "), a), lit("| x |"), lit("| x |"), lit("| x |"), lit("| x |"))
    return _four(spark, sf).select("doc_id", "n0", tables.is_complex(headers, rows, md).alias("complex"))


@query(f"""WITH {FOUR} SELECT doc_id, n0, '| x' || a || '\\|y | B' || b || ' |' || {NL} || '| --- | --- |' || {NL} || '| 1<br>2 | ' || CASE WHEN n0 % 2 = 0 THEN c || 'Zz' ELSE '' END || ' |' AS markdown FROM four""")
def str_pipe_table(spark, sf):
    n = F.col("n0")
    headers = F.array(C(lit("x"), "a", lit("|y")), C(lit(" B"), "b"))
    row = F.array(lit("1\n2"), F.when(n % 2 == 0, C("c", lit("Zz"))), lit("left out"))
    return _four(spark, sf).select("doc_id", "n0", T.pipe_table(headers, F.array(row)).alias("markdown"))


@query(f"""WITH {FOUR} SELECT doc_id, n0, '<div class="complex-table-block" data-table-id="t' || n0 || '" data-table-role="child" data-parent-table-id="&lt;' || a || '&quot;">' || {NL} || '  <p class="complex-table-title"><strong>T&amp;' || b || '</strong></p>' || {NL} || '  <table>' || {NL} || '    <thead>' || {NL}
 || '      <tr><th>' || a || '</th></tr>' || {NL} || '    </thead>' || {NL} || '    <tbody>' || {NL} || '      <tr><td>&lt;' || c || '<br/>2</td></tr>' || {NL} || '    </tbody>' || {NL} || '  </table>' || {NL} || '</div>' AS html FROM four""")
def str_table_html(spark, sf):
    html = tables.table_html(F.array("a"), F.array(F.array(C(lit("<"), "c", lit("\n2")))), C(lit("t"), F.col("n0").cast("string")), lit("child"), C(lit("<"), "a", lit('"')), C(lit("T&"), "b"))
    return _four(spark, sf).select("doc_id", "n0", html.alias("html"))


@query(f"""WITH {FOUR}, t AS (SELECT doc_id, n0, [{"'x' || a || ' + 章' || b, a, 'up + ' || c"}][CAST(n0 % 3 AS INTEGER) + 1] AS this_title, 'z' || d AS next_title, line FROM four)
SELECT doc_id, n0, len(list_filter(list_transform(string_split(this_title, ' + '), lambda x: trim(x)), lambda x: length(x) >= CASE WHEN regexp_matches(x, '[^\\x00-\\x7F]') THEN 2 ELSE 4 END AND contains('go 章' || lower(line), x))) > 0
 OR (length(next_title) >= 4 AND contains('z' || lower(line), next_title)) AS overlap FROM t""")
def prd_title_overlap(spark, sf):
    from quire.operators import planner

    title = _by(F.col("n0"), 3, C(lit("x"), "a", lit(" + 章"), "b"), F.col("a"), C(lit("up + "), "c"))
    met = planner.titles_meet(title, C(lit("z"), "d"), C(lit("go 章"), F.lower("line")), C(lit("z"), F.lower("line")))
    return _four(spark, sf).select("doc_id", "n0", met.alias("overlap"))


@query(f"""WITH {FOUR}, s AS (SELECT *, lpad(CAST(n0 % 20 AS VARCHAR), 3, '0') || '-' || trim('T_' || a, '. ') AS folder FROM four)
SELECT doc_id, n0, 'x ![p](assets/' || folder || '/a' || b || '.png) <img src="assets/' || folder || '/b.png"> ![q](other/c.png)' AS markdown, CAST(2 AS BIGINT) AS relinks FROM s""")
def str_rewrite_paths(spark, sf):
    rows = _four(spark, sf).select("doc_id", "n0", (F.col("n0") % 20).cast("int").alias("order_index"), C(lit("T:"), "a", lit(". ")).alias("display_title"), C(lit("x ![p](assets/a"), "b", lit('.png) <img src="assets/b.png"> ![q](other/c.png)')).alias("markdown"))
    return merge.relinked(rows).select("doc_id", "n0", "markdown", F.size("relinks").cast("long").alias("relinks"))


@query(f"""WITH {FOUR}, c AS (SELECT doc_id * 1000 + n0 AS id, length(a) AS before, length(b) AS after, CASE WHEN n0 % 7 = 3 THEN ' ' ELSE a || '.png' END AS md, [a || '.png', b || '.png', ''] AS ps FROM four)
SELECT id AS doc_id, 'format_parse_unstable' AS issue_type, 'error' AS severity FROM c WHERE md = ' ' OR (before > 0 AND abs(after - before) > before * 0.2) UNION ALL SELECT id, 'asset_not_found', 'warning' FROM (SELECT id, md, unnest(ps) AS p FROM c WHERE md <> ' ') WHERE p <> '' AND NOT contains(md, p)""")
def chk_format(spark, sf):
    n = F.col("n0")
    rows = _four(spark, sf).select((F.col("doc_id") * 1000 + n).alias("doc_id"), F.length("a").alias("before"), F.length("b").alias("after"), F.when(n % 7 == 3, " ").otherwise(C("a", lit(".png"))).alias("markdown"), F.array(C("a", lit(".png")), C("b", lit(".png")), lit("")).alias("asset_paths"))
    return merge.format_checks(rows)


CODED = _sql_by("n0", 4, "'x' || a || '.y' || b || '(1);'", "'return x' || a || ';'", "CASE WHEN length(b) % 2 = 0 THEN '}' ELSE 'int x' || b || ' = 1;' END", "CASE WHEN n0 % 3 = 0 THEN 'Plain x' || a || ' words' ELSE 'import x' || a END")


def _code_rows(spark, sf):
    n, xa = F.col("n0"), C(lit("x"), "a")
    text = _by(n, 4, C(xa, lit(".y"), "b", lit("(1);")), C(lit("return "), xa, lit(";")), F.when(F.length("b") % 2 == 0, "}").otherwise(C(lit("int x"), "b", lit(" = 1;"))), F.when(n % 3 == 0, C(lit("Plain "), xa, lit(" words"))).otherwise(C(lit("import "), xa)))
    return _rows(spark, sf, F.when(n % 11 == 10, "quote").otherwise("paragraph"), text).withColumn("page", (F.floor(n / 12) + 1).cast("int"))


CODE_RUNS = f"""{FOUR}, b AS (SELECT doc_id, n0 + 1 AS rn, CAST(n0 // 12 + 1 AS INTEGER) AS page, {CODED} AS m, n0 % 11 <> 10 AS prose FROM four), k AS (SELECT *, prose AND regexp_matches(m, '[a-zA-Z]') AND NOT starts_with(m, 'Plain') AS code FROM b),
g AS (SELECT *, rn - row_number() OVER (PARTITION BY doc_id, page, code ORDER BY rn) AS run FROM k), i AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page, code, run) AS n, row_number() OVER (PARTITION BY doc_id, page, code, run ORDER BY rn) AS at_ FROM g)"""


@query(f"WITH {CODE_RUNS} SELECT doc_id, page, rn AS first_rn, n FROM i WHERE code AND n >= 3 AND at_ = 1")
def fld_code_islands(spark, sf):
    return repair.code_islands(_code_rows(spark, sf))


@query(f"WITH {CODE_RUNS}, r AS (SELECT doc_id, page, run, '```' || {NL} || string_agg(m, {NL} ORDER BY rn) || {NL} || '```' AS body FROM i WHERE code AND n >= 3 GROUP BY doc_id, page, run) SELECT i.doc_id, rn, CASE WHEN code AND n >= 3 THEN CASE WHEN at_ = 1 THEN body ELSE '' END ELSE m END AS markdown FROM i LEFT JOIN r ON r.doc_id = i.doc_id AND r.page = i.page AND r.run = i.run AND code AND n >= 3")
def fld_code_merged(spark, sf):
    return repair.merge_code(_code_rows(spark, sf)).select("doc_id", "rn", "markdown")


@query(f"WITH {FOUR}, m AS (SELECT doc_id, n0, 'x' || a || ' y' || b AS t FROM four) SELECT doc_id, n0 + 1 AS rn FROM m WHERE n0 % 5 <> 4 AND length(t) >= 8 AND EXISTS (SELECT 1 FROM m f WHERE f.doc_id = m.doc_id AND f.n0 % 3 = 1 AND contains(f.t || ' tail', m.t))")
def jn_code_recover(spark, sf):
    """Each third line stands in a fence of the draft, with a word more."""
    n = F.col("n0")
    text = C(lit("x"), "a", lit("  y"), "b")
    rows = _rows(spark, sf, F.when(n % 5 == 4, "quote").otherwise("paragraph"), text)
    part = F.when(n % 3 == 1, C(lit("```\n"), text, lit("\ntail\n```"))).otherwise("a")
    drafts = _four(spark, sf).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n0", part.alias("p")))), lambda x: x["p"]), "\n").alias("markdown"))
    return repair.recover_code(rows, drafts).where("block_type = 'code'").select("doc_id", "rn")

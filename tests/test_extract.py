"""The extract phase from laid-out pages to content, and on to formatted Markdown."""

import json

from quire import cli
from quire.plans import extract, phases


def span(text, top, bottom, size=11.0, font="Serif"):
    return {"type": 0, "bbox": [50.0, top, 500.0, bottom], "lines": [{"spans": [{"text": text, "font": font, "size": size}]}]}


def snapshot(rows, top, bottom, markdown="| Name | Value |\n| --- | --- |"):
    return {"bbox": [50.0, top, 550.0, bottom], "headers": ["Name", "Value"], "rows": rows, "markdown": markdown, "cross_page": None, "cross_page_count": None}


def page(name, n, blocks, text, tables=(), images=()):
    return {"slice_file": name, "page": n, "width": 600.0, "height": 1000.0, "blocks": blocks, "text": text, "tables": list(tables), "images": list(images)}


PAGES = [
    page("a.pdf", 1, [span("First", 100.0, 130.0, 20.0), span("Some words here.", 300.0, 320.0), span("Figure 1 a cat", 505.0, 520.0)], "# First\n\nSome words here.", [snapshot([["abc", "def"]], 500.0, 950.0)], [{"asset_path": "assets/p.png", "bbox": [60.0, 350.0, 200.0, 500.0]}]),
    page("a.pdf", 2, [span("More words.", 400.0, 420.0)], "More words.", [snapshot([["ghi", "jkl"]], 50.0, 200.0)]),
    page("b.pdf", 1, [], ""),
    page("c.pdf", 2, [span("x", 1.0, 2.0)], "x"),
]
SLICES = [("a.pdf", "First", 5, 6, [6], False), ("b.pdf", "B", 7, 7, [], False), ("c.pdf", "C", 8, 8, [], False), ("d.pdf", "D", 9, 9, [], False)]


def test_extract_and_format(spark):
    out = extract.extract_phase(spark.createDataFrame(PAGES, extract.PAGES), spark.createDataFrame(SLICES, extract.SLICES))
    records = {r.slice_file: (r.status, r.error_code, r.manual_review_required) for r in out["records"].collect()}
    assert records == {"a.pdf": ("success", None, True), "b.pdf": ("failed", "EMPTY_EXTRACTION", True), "c.pdf": ("failed", "PAGE_MAPPING", True), "d.pdf": ("failed", "MISSING_SLICE", True)}
    content = out["content"].collect()[0]
    first, second = content.source_pages
    assert [(b.type, b.source_page) for b in first.blocks] == [("heading", 5), ("paragraph", 5), ("paragraph", 5)] and first.blocks[0].heading_level == 1
    assert second.is_overlap and not first.is_overlap and first.blocks[1].dedupe_key.startswith("5:")
    assert first.tables[0].table_id == "p0005-t01" and first.tables[0].rows == [["abc", "def"], ["ghi", "jkl"]] and second.tables == []
    assert first.images[0].caption == "Figure 1 a cat" and content.warnings == ["complex_table:5:1"]
    assert out["stats"].collect()[0].table_count == 1
    drafts = extract.drafts(out["content"])
    assert "Some words here." in drafts.first().markdown and "complex-table-block" in drafts.first().markdown
    done = phases.format_phase(out["content"], drafts)["documents"].first()
    assert done.markdown.startswith("# First\n") and "| abc | def |" in done.markdown and "![Figure 1 a cat](assets/p.png)" in done.markdown


def test_extract_command(spark, tmp_path):
    manifest = {"source_file": "x.pdf", "total_pages": 9, "slices": [{"slice_file": "a.pdf", "display_title": "First", "start_page": 5, "end_page": 6, "overlap_pages": [6], "manual_review_required": False}]}
    (tmp_path / "m.json").write_text(json.dumps(manifest))
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, PAGES[:2])))
    args = ["extract", "--input-manifest", str(tmp_path / "m.json"), "--pages", str(tmp_path / "pages.json"), "--output-dir"]
    assert cli.main([*args, str(tmp_path / "out")]) == 0 and cli.main([*args, str(tmp_path / "out")]) == 1
    assert spark.read.json(str(tmp_path / "out" / "drafts")).count() == 1

"""Phases, sources, sinks, the stream and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from quire import cli
from quire import schemas as S
from quire.plans import phases
from quire.sources import layout, manifests, sinks
from quire.streaming.manifests import watch

BLOCK = ["type", "text", "source_page", "bbox", "reading_order", "is_overlap", "dedupe_key", "heading_level"]


def b(kind, text, order, key, level=None):
    return dict(zip(BLOCK, (kind, text, 1, None, order, False, key, level), strict=True))


def page(n, blocks, tables=(), images=(), overlap=False, markdown="x"):
    return {"slice_page": n, "source_page": n, "is_overlap": overlap, "markdown": markdown, "blocks": blocks, "tables": list(tables), "images": list(images)}


CONTENT = [
    {
        "slice_file": "one.pdf", "display_title": "Chapter one", "start_page": 1, "end_page": 2, "warnings": [], "manual_review_required": False,
        "source_pages": [
            page(1, [b("heading", "Start", 1, "k1", 2), b("paragraph", "Words that are found.", 2, "k2"), b("paragraph", "Nowhere to be seen at all", 3, "k3")],
                 [{"table_id": "p0001-t01", "headers": ["Name", "Value"], "rows": [["abc", "def"]], "markdown": None, "fallback_html": None, "fallback_image": None, "bbox": [0.0, 500.0, 10.0, 20.0]}],
                 [{"asset_path": "assets/p.png", "caption": "A cat", "bbox": [0.0, 600.0, 10.0, 20.0]}]),
            page(2, [b("paragraph", "it goes", 1, "k4"), b("paragraph", "on here", 2, "k5")], overlap=True, markdown=""),
        ],
    },
]
DRAFT = [("one.pdf", "## Start\n\nWords that are found.\n\nit goes\n\non here\n")]


def test_format_phase(spark):
    content = spark.createDataFrame(CONTENT, S.CONTENT)
    out = phases.format_phase(content, spark.createDataFrame(DRAFT, "doc_id string, markdown string"))
    assert tuple(out["coverage"].first())[1:] == (5, 4)
    issues = {(r.issue_type, r.severity, r.node_ref) for r in out["issues"].collect()}
    assert {("missing_block", "warning", "k3"), ("table_render_failed", "error", "table:1:0"), ("image_reference_missing", "warning", "image:1:0"), ("overlap_lost", "warning", "2")} <= issues
    doc = out["documents"].first()
    assert doc.markdown == "# Chapter one\n\n## Start\n\nWords that are found.\n\nNowhere to be seen at all\n\n| Name | Value |\n| --- | --- |\n| abc | def |\n\n![A cat](assets/p.png)\n\nit goes on here\n"
    assert doc.manual_review_required and doc.passed
    fixes = {r.fix_type for r in out["fixes"].collect()}
    assert {"heading_inserted", "missing_block_restored", "table_rebuilt", "image_reference_restored", "overlap_block_restored", "paragraph_merged"} <= fixes


SLICES = "book string, slice long, display_title string, start_page int, end_page int, markdown string, manual_review_required boolean"
BOOK = [("b", 1, "One", 1, 10, "# One\n\nfirst\n\nshared paragraph", False), ("b", 2, "Two", 10, 20, "# Two\n\nshared paragraph\n\nlast", False), ("c", 1, "X", 1, 2, "# X", True), ("c", 2, "Y", 5, 9, "# Y", False)]


def test_merge_phase(spark):
    slices = spark.createDataFrame(BOOK, SLICES)
    plain = {r.book: r.markdown for r in phases.merge_phase(slices)["books"].collect()}
    assert plain["b"].count("shared paragraph") == 2 and plain["c"] == "# X\n\n# Y\n"
    refs = [("b", 1, 1, 1, "heading", "k1", "h1", None, False, "# One"), ("b", 1, 2, 10, "paragraph", "k2", "h2", None, True, "shared paragraph"), ("b", 2, 1, 10, "heading", "k1", "h1", None, True, "# One"), ("b", 2, 2, 10, "paragraph", "k2", "h2", None, True, "shared paragraph"), ("b", 2, 3, 11, "paragraph", "k3", "h3", None, False, "last")]
    rows = spark.createDataFrame(refs, "book string, slice long, ordinal long, source_page int, block_type string, dedupe_key string, text_hash string, asset_ref string, is_overlap boolean, markdown string")
    out = phases.merge_phase(slices.where("book = 'b'"), rows)
    assert out["books"].first().markdown == "# One\n\nshared paragraph\n\n# One\n\nlast\n"
    assert {r.warning_type for r in phases.merge_phase(slices)["warnings"].where("book = 'c'").collect()} == {"page_gap"}
    assert phases.merge_phase(slices.where("book = 'c'"), separator="\n\n---\n\n")["books"].first().markdown == "# X\n\n---\n\n# Y\n"
    assert {r.book: r.status for r in phases.may_merge(slices).collect()} == {"b": "success", "c": "aborted_upstream_invalid"}
    assert {r.status for r in phases.may_merge(slices, True).collect()} == {"success"}


@pytest.fixture()
def layouts(tmp_path):
    folder = tmp_path / "layouts"
    folder.mkdir()
    pages = [{"width": 600, "height": 1000, "blocks": [{"type": 0, "bbox": [50, 100, 500, 120], "lines": [{"spans": [{"text": f"Chapter {n}" if n % 10 == 1 else "Words.", "font": "Serif", "size": 11}]}]}]} for n in range(1, 41)]
    (folder / "d.json").write_text(json.dumps({"doc_id": "d", "pages": pages}))
    (tmp_path / "toc.json").write_text("")
    (tmp_path / "texts.json").write_text("\n".join(json.dumps({"doc_id": "d", "page": n, "text": "Words."}) for n in range(1, 41)))
    return tmp_path


def test_layout_source_and_slice_command(spark, layouts):
    rows = layout.read_layouts(spark, str(layouts / "layouts"))
    assert rows.count() == 40 and rows.first().blocks[0].lines[0].spans[0].text
    args = ["slice", "--layouts", str(layouts / "layouts"), "--toc", str(layouts / "toc.json"), "--texts", str(layouts / "texts.json"), "--output-dir", str(layouts / "out")]
    assert cli.main(args) == 0 and cli.main(args) == 1 and cli.main([*args, "--overwrite"]) == 0
    found = spark.read.json(str(layouts / "out" / "slices")).orderBy("pos").collect()
    assert [(r.start_page, r.end_page) for r in found] == [(1, 21), (21, 40)] and found[0].overlap_pages == [21]


def test_merge_and_format_commands(spark, tmp_path):
    spark.createDataFrame(BOOK, SLICES).write.json(str(tmp_path / "in" / "documents"))
    args = ["merge", "--input-dir", str(tmp_path / "in"), "--output-dir"]
    assert cli.main([*args, str(tmp_path / "a")]) == 1
    assert cli.main([*args, str(tmp_path / "b"), "--allow-upstream-manual-review"]) == 0
    assert spark.read.json(str(tmp_path / "b" / "books")).count() == 2
    spark.createDataFrame(CONTENT, S.CONTENT).write.json(str(tmp_path / "f" / "content"))
    spark.createDataFrame(DRAFT, "doc_id string, markdown string").write.json(str(tmp_path / "f" / "drafts"))
    args = ["format", "--input-dir", str(tmp_path / "f"), "--output-dir", str(tmp_path / "g")]
    assert cli.main(args) == 0 and cli.main([*args, "--overwrite", "--fail-on-manual-review"]) == 1


def test_files_of_commands(spark, tmp_path):
    """Reports, texts and assets in a folder for each slice; paths to the source's folder where assets stay."""
    spark.createDataFrame(CONTENT, S.CONTENT).write.json(str(tmp_path / "f" / "content"))
    spark.createDataFrame(DRAFT, "doc_id string, markdown string").write.json(str(tmp_path / "f" / "drafts"))
    args = ["format", "--input-dir", str(tmp_path / "f"), "--output-dir"]
    assert cli.main([*args, str(tmp_path / "a"), "--no-copy-assets"]) == 0
    manifest = spark.read.schema(S.FORMAT_MANIFEST).json(str(tmp_path / "a" / "manifest")).first()
    assert manifest.total_slices == len(manifest.slices) and [x.order_index for x in manifest.slices] == list(range(1, manifest.total_slices + 1))
    for x in manifest.slices:
        report = json.loads((tmp_path / "a" / "files" / x.review_report_file).read_text())
        assert report["doc_id"] == x.slice_file and report["coverage"]["matched"] <= report["coverage"]["expected"]
        assert (tmp_path / "a" / "files" / x.final_md_file).read_text().strip()
    assert {r.warning for r in spark.read.schema("path string, warning string").json(str(tmp_path / "a" / "written")).collect()} == {None}


def test_sinks(spark, tmp_path):
    slices = spark.createDataFrame([("d", 2, "B", 3, 4, "b.pdf"), ("d", 1, "A", 1, 2, "a b.pdf")], "doc_id string, pos int, title string, start_page int, end_page int, slice_file string")
    more = {"toc_level": F.lit(1), "split_mode": F.lit("chapter"), "overlap_pages": F.array().cast("array<int>"), "boundary_reason": F.lit("chapter_boundary"), "exception_type": F.lit(None).cast("string"), "manual_review_required": F.lit(False)}
    documents = spark.createDataFrame([("d", 4, 2)], "doc_id string, total_pages int, fallback_level int")
    made = sinks.slice_manifests(slices.withColumns(more), documents, "now")
    row = made.first()
    assert (row.source_file, row.total_pages, row.fallback_level, row.created_at) == ("d", 4, 2, "now") and [(s.slice_file, s.actual_pages) for s in row.slices] == [("a b.pdf", 2), ("b.pdf", 2)]
    made.write.json(str(tmp_path / "m"))
    rows = manifests.slices(manifests.read(spark, str(tmp_path / "m"), "slice"))
    assert manifests.slice_errors(rows).count() == 0
    (tmp_path / "there").mkdir()
    (tmp_path / "there" / "a b.pdf").write_bytes(b"x")
    assert [tuple(r) for r in sinks.missing_files(rows, str(tmp_path / "there")).collect()] == [("b.pdf", "MISSING_FILE")]
    records = spark.createDataFrame([("a b.pdf", "success", None, 1, True), ("b.pdf", "failed", "E", 0, True)], "slice_file string, status string, error_code string, warning_count int, manual_review_required boolean")
    done = sinks.extract_manifests(records, rows, "now").first()
    assert (done.total_slices, done.success_count, done.failed_count, done.total_warnings) == (2, 1, 1, 1) and [s.content_file for s in done.slices] == ["001-a b/content.json", None]
    source = spark.createDataFrame([("a b.pdf", "x/y.pdf"), ("none.pdf", "z.pdf")], "name string, to string")
    out = sinks.copied(source, str(tmp_path / "there"), str(tmp_path / "copy")).collect()
    assert (tmp_path / "copy" / "x" / "y.pdf").read_bytes() == b"x" and sum(r.warning is not None for r in out) == 1
    merged = phases.merge_phase(spark.createDataFrame(BOOK, SLICES))
    reports = {r.book: r for r in sinks.merge_reports(merged).collect()}
    assert len(reports) == merged["books"].count() and all(r.status == "success" for r in reports.values())
    assert sinks.run_summary(merged).first().books == len(reports)


def test_layout_files(spark, tmp_path):
    doc = {"doc_id": "d", "pages": [{"width": 6, "height": 10, "blocks": [{"type": 0, "bbox": [0, 0, 1, 1], "lines": [{"spans": [{"text": "t", "font": "f", "size": 9}]}]}]}]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    by_source = layout.read_layouts(spark, str(tmp_path)).collect()
    assert layout.layouts_of(layout.files(spark, str(tmp_path))).collect() == by_source and by_source[0].blocks[0].lines[0].spans[0].text == "t"


def test_manifests(spark, tmp_path):
    one = {"source_manifest": "m", "source_file": "a.pdf", "slices": [{"slice_file": "x", "status": "success", "warning_count": 1}, {"slice_file": "y", "status": "failed"}]}
    (tmp_path / "m.json").write_text(json.dumps(one, indent=1))
    (tmp_path / "bad.json").write_text("{nope")
    found = manifests.read(spark, str(tmp_path), "extract").cache()
    assert found.where("_corrupt_record IS NOT NULL").count() == 1
    rows = manifests.slices(found)
    assert [(r.slice_number, r.slice_file) for r in manifests.succeeded(rows).collect()] == [(1, "x")]
    assert {r.field for r in manifests.missing_keys(found.where("source_file IS NULL"), "extract").collect()} == {"source_manifest", "source_file", "slices"}
    assert manifests.without_slices(found.where("source_file IS NOT NULL")).count() == 0
    order = spark.createDataFrame([("a", 1, "success"), ("a", 1, "success"), ("a", 2, "failed")], "source_file string, order_index int, status string")
    assert manifests.order_errors(order).count() == 1
    assert manifests.failure(rows.where("slice_number = 2"), "E", "m").first().manual_review_required
    t = spark.createDataFrame([({"a": 0, "b": 5},)], "stage_timings map<string,long>")
    assert manifests.timings(t).first().stage_timings == {"a": 1, "b": 5, "total": 6}


def test_density(spark):
    rows = [("a", 1, "one two three four five six"), ("b", 1, "x"), ("c", 1, "word " * 6), ("c", 2, ""), ("d", 1, None)]
    assert {r.doc_id: (r.words, r.supported) for r in layout.density(spark.createDataFrame(rows, "doc_id string, page int, text string")).collect()} == {"a": (6, True), "b": (1, False), "c": (6, True), "d": (0, False)}


def test_parsers_and_exports(spark, tmp_path):
    def parser(content):
        if content == b"locked":
            raise PermissionError
        if content == b"broken":
            raise ValueError
        text = content.decode()
        return [] if text == "none" else [{"width": 1, "height": 1, "blocks": [{"type": 0, "bbox": [0, 0, 1, 1], "lines": [{"spans": [{"text": text}]}]}]}]

    df = spark.createDataFrame([("a", b"text"), ("b", b"locked"), ("c", b"broken"), ("d", b"none"), ("e", b" ")], "path string, content binary")
    assert {r.doc_id: r.status for r in layout.open_documents(df, parser).collect()} == {"a": "ok", "b": "encrypted", "c": "damaged", "d": "empty", "e": "no_text"}

    def writer(row):
        if row["ordinal"] == 2:
            raise OSError
        return f"{row['name']}", row["content"]

    parts = spark.createDataFrame([(1, 1, b"A"), (1, 2, b"B")], "page int, ordinal int, content binary").withColumn("name", layout.asset_name("img"))
    out = layout.export(parts, str(tmp_path / "assets"), writer).collect()
    assert (tmp_path / "assets" / "p0001_img01.png").read_bytes() == b"A" and {r.warning for r in out} == {None, "export_failed:1:2:OSError"}


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "m.json").write_text(json.dumps({"source_file": "a.pdf", "total_pages": 3, "slices": [{"slice_file": "x", "start_page": 0, "end_page": 2}]}))
    watch(spark, str(source), "slice", lambda df: manifests.slice_errors(manifests.slices(df)), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    assert [r.error_code for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["BAD_START"]


def test_slices_with_provenance_from_documents(spark, data):
    from quire.sources import adapters

    rows = adapters.slices(adapters.keyed(adapters.blocks(spark.read.parquet(f"{data}/documents.parquet"))))
    assert rows.where(F.col("is_overlap")).count() >= 0 and rows.select("slice").distinct().count() >= 1

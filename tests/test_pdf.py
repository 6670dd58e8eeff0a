"""The PDF reader and writer, on files that are made here."""

import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire import cli
from quire.sources import layout, pdf
from quire.sources.pdf import Name, Ref, Stream

PAGE_TEXT = [b"BT /F1 20 Tf 72 700 Td (Title \\(one\\)) Tj ET BT /F1 11 Tf 72 640 Td (First ) Tj (line) Tj 0 -14 Td [(sec) -20 (ond) -300 (line)] TJ ET", b"BT /F2 10 Tf 1 0 0 1 50 500 Tm <00010002> Tj ET q 100 0 0 50 72 300 cm /I1 Do Q"]
MAP = b"1 beginbfchar <0001> <0048> endbfchar 1 beginbfrange <0002> <0003> <00E9> endbfrange"


def flate(data, **fields):
    return Stream({"Filter": Name("FlateDecode"), **fields}, zlib.compress(data))


def objects(n_pages=2, texts=PAGE_TEXT):
    fonts = {"F1": Ref(20), "F2": Ref(21)}
    out = {
        1: {"Type": Name("Catalog"), "Pages": Ref(2), "Outlines": Ref(30)}, 2: {"Type": Name("Pages"), "Kids": [Ref(3 + i) for i in range(n_pages)], "Count": n_pages, "MediaBox": [0, 0, 600, 800], "Resources": {"Font": fonts, "XObject": {"I1": Ref(25)}}},
        20: {"Type": Name("Font"), "Subtype": Name("Type1"), "BaseFont": Name("ABCDEF+Serif"), "FirstChar": 32, "Widths": [500] * 95}, 21: {"Type": Name("Font"), "Subtype": Name("Type0"), "BaseFont": Name("Sans"), "ToUnicode": Ref(22)}, 22: flate(MAP),
        25: flate(bytes(range(12)), Type=Name("XObject"), Subtype=Name("Image"), Width=2, Height=2, BitsPerComponent=8, ColorSpace=Name("DeviceRGB")),
        30: {"First": Ref(31)}, 31: {"Title": b"One", "Dest": [Ref(3), Name("Fit")], "First": Ref(32), "Next": Ref(33)}, 32: {"Title": b"\xfe\xff\x00D\x00\xe9", "A": {"S": Name("GoTo"), "D": [Ref(4), Name("Fit")]}}, 33: {"Title": b"Nowhere", "Dest": b"x"},
    }
    for i in range(n_pages):
        out[3 + i] = {"Type": Name("Page"), "Parent": Ref(2), "Contents": Ref(10 + i)}
        out[10 + i] = flate(texts[i % len(texts)])
    return out


def lines(page):
    return ["".join(s["text"] for s in x["spans"]) for b in page["blocks"] for x in b["lines"]]


def test_pages():
    first, second = pdf.pages(pdf.written(objects(), 1))
    assert lines(first) == ["Title (one)", "First line", "second line"] and (first["width"], first["height"]) == (600.0, 800.0)
    assert [len(b["lines"]) for b in first["blocks"]] == [1, 2] and [b["lines"][0]["spans"][0]["size"] for b in first["blocks"]] == [20.0, 11.0]
    assert first["blocks"][0]["bbox"][:2] == [72.0, 800 - 700 - 16] and first["blocks"][0]["lines"][0]["spans"][0]["font"] == "Serif"
    assert lines(second) == ["Hé"] and second["images"] == [{"bbox": [72.0, 450.0, 172.0, 500.0]}]


def test_contents_and_images():
    data = pdf.written(objects(), 1)
    assert pdf.Pdf(data).contents() == [(1, "One", 1), (2, "Dé", 2)]
    ((page, number, suffix, content),) = pdf.images(data)
    assert (page, number, suffix) == (2, 1, "png") and content == pdf.png(bytes(range(12)), 2, 2, True)


def test_object_streams():
    inner = {2: {"Type": Name("Pages"), "Kids": [Ref(3)], "Count": 1}, 3: {"Type": Name("Page"), "Contents": Ref(10), "Resources": {"Font": {"F1": {"BaseFont": Name("X")}}}}}
    bodies = [pdf.stored(v) for v in inner.values()]
    head = b"2 0 3 %d " % (len(bodies[0]) + 1)
    packed = flate(head + b" ".join(bodies), Type=Name("ObjStm"), N=2, First=len(head))
    data = pdf.written({1: {"Type": Name("Catalog"), "Pages": Ref(2)}, 5: packed, 10: flate(b"BT /F1 9 Tf (in a stream) Tj ET")}, 1)
    assert [lines(p) for p in pdf.pages(data)] == [["in a stream"]]


def test_ranges_of_pages():
    data = pdf.written(objects(5), 1)
    part = pdf.page_range(data, 2, 4)
    assert [lines(p) for p in pdf.pages(part)] == [lines(p) for p in pdf.pages(data)][1:4]
    assert len(list(pdf.images(part))) == 2 and [lines(p) for p in pdf.pages(pdf.page_range(part, 1, 1))] == [["Hé"]]
    for bad in ((3, 2), (0, 1), (4, 6)):
        with pytest.raises(ValueError):
            pdf.page_range(data, *bad)


def test_states_of_files(spark, tmp_path):
    good = pdf.written(objects(), 1)
    locked = good.replace(b"trailer\n<<", b"trailer\n<</Encrypt 40 0 R ")
    files = {"good": good, "damaged": b"%PDF-1.4 nothing", "not": b"text", "locked": locked, "empty": pdf.written(objects(0), 1), "blank": pdf.written(objects(2, [b"q Q"]), 1)}
    for name, data in files.items():
        (tmp_path / f"{name}.pdf").write_bytes(data)
    rows = {r.doc_id.rpartition("/")[2]: r.status for r in layout.open_documents(layout.files(spark, str(tmp_path)), pdf.pages).collect()}
    assert rows == {"good.pdf": "ok", "damaged.pdf": "damaged", "not.pdf": "damaged", "locked.pdf": "encrypted", "empty.pdf": "empty", "blank.pdf": "no_text"}


def test_layouts_contents_and_slices_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(pdf.written(objects(4), 1))
    (tmp_path / "in" / "b.pdf").write_bytes(b"%PDF-1.4 nothing")
    files = layout.files(spark, str(tmp_path / "in"))
    pages = layout.pdf_layouts(files)
    assert [(r.page, len(r.blocks), len(r.images)) for r in pages.orderBy("page").collect()] == [(1, 2, 0), (2, 1, 1), (3, 2, 0), (4, 1, 1)]
    assert [(r.level, r.title, r.page) for r in layout.pdf_contents(files).orderBy("pos").collect()] == [(1, "One", 1), (2, "Dé", 2)]
    slices = spark.createDataFrame([("a.pdf", 1, 2, "one.pdf"), ("a.pdf", 3, 9, "bad.pdf")], "doc_id string, start_page int, end_page int, slice_file string")
    out = {r.slice_file: r.warning for r in layout.pdf_slices(files, slices, str(tmp_path / "out")).collect()}
    assert out["one.pdf"] is None and out["bad.pdf"] and len(list(pdf.pages((tmp_path / "out" / "one.pdf").read_bytes()))) == 2
    names = sorted(r.path.rpartition("/")[2] for r in layout.pdf_images(files, str(tmp_path / "assets")).collect() if r.path)
    assert names == ["p0002_img01.png", "p0004_img01.png"] and (tmp_path / "assets" / "a.pdf" / names[0]).exists()


def test_commands_on_files(spark, tmp_path):
    """From PDF files to slices and on to their content."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(pdf.written(objects(4), 1))
    assert cli.main(["slice", "--pdfs", str(tmp_path / "in"), "--output-dir", str(tmp_path / "s")]) == 0
    made = sorted((tmp_path / "s" / "files").glob("*.pdf"))
    assert sum(len(list(pdf.pages(p.read_bytes()))) for p in made) >= 4
    manifest = next(p for p in (tmp_path / "s" / "manifest").glob("*.json") if p.stat().st_size)
    assert cli.main(["extract", "--input-manifest", str(manifest), "--pdfs", str(tmp_path / "s" / "files"), "--output-dir", str(tmp_path / "e")]) == 0
    records = spark.read.json(str(tmp_path / "e" / "records")).collect()
    assert {r.status for r in records} == {"success"} and len(records) == len(made)
    assert "First line" in " ".join(r.markdown for r in spark.read.json(str(tmp_path / "e" / "drafts")).collect())


values = st.recursive(st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.binary(max_size=20) | st.text(st.characters(min_codepoint=33, max_codepoint=255), min_size=1, max_size=8).map(Name), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text("abcXYZ", min_size=1, max_size=4), x, max_size=4), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(values)
def test_values_read_as_they_are_stored(value):
    assert pdf.Scanner(pdf.stored(value)).value() == value


def test_strings_of_files():
    assert pdf.Scanner(rb"(a\(b\)(c)\n\101\
x)").value() == b"a(b)(c)\nAx" and pdf.Scanner(b"<4 1 4>").value() == b"A@"

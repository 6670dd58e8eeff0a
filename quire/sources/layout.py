"""Page layouts from files: a Python data source over JSON pages, and PDFs by way of a parser.

A parser is a function from the bytes of a file to an iterator of pages (dicts as in ``schemas.PAGE_LAYOUT`` without doc_id);
``quire.sources.pdf.pages`` is one, and any other can be plugged in."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.schemas import PAGE_LAYOUT, TOC

#: Least text of a file that can be worked on: words and characters in all, and a page on average.
WORDS, CHARS, WORDS_A_PAGE, CHARS_A_PAGE = 5, 20, 1.0, 8.0
STATUS = ("missing", "damaged", "encrypted", "empty", "no_text")


class LayoutSource(DataSource):
    """spark.read.format("quire_layout").load(folder): one partition a .json file of {doc_id, pages: [...]}. The driver lists the folder;
    for millions of layouts ``layouts_of`` reads the files that Spark lists."""

    @classmethod
    def name(cls):
        return "quire_layout"

    def schema(self):
        return PAGE_LAYOUT

    def reader(self, schema):
        return LayoutReader(self.options["path"])


class LayoutReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        scheme = self.path.partition("://")[0] if "://" in self.path else "file"
        return [InputPartition(f"{scheme}://{f.path}") for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.path.endswith(".json")]

    def read(self, partition):
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(partition.value)
        with store.open_input_stream(inner) as stream:
            yield from pages_of(json.loads(stream.read()))


def pages_of(doc: dict):
    """Rows of a page layout from one document."""
    box = lambda b: [float(x) for x in b]
    for n, p in enumerate(doc["pages"], start=1):
        blocks = [(b["type"], box(b["bbox"]), [([(s.get("text"), s.get("font"), float(s.get("size", 0))) for s in x.get("spans", [])],) for x in b.get("lines", [])]) for b in p.get("blocks", [])]
        yield (str(doc["doc_id"]), int(p.get("page", n)), float(p["width"]), float(p["height"]), blocks, [(box(t["bbox"]),) for t in p.get("tables", [])], [(box(t["bbox"]),) for t in p.get("images", [])])


def layouts_of(contents: DataFrame) -> DataFrame:
    """Page layouts of JSON files (path, content) that Spark has listed, as ``files`` gives them."""

    def run(batches):
        for pdf in batches:
            rows = [row for content in pdf["content"] for row in pages_of(json.loads(content))]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "width", "height", "blocks", "tables", "images"])

    return contents.select("content").mapInPandas(run, PAGE_LAYOUT)


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(LayoutSource)
    return spark.read.format("quire_layout").load(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """Files as rows: path, content."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def open_documents(contents: DataFrame, parser: Callable[[bytes], Iterable[dict]]) -> DataFrame:
    """Files (path, content) to doc_id, status and pages as JSON. A parser raises PermissionError for an encrypted file and anything
    else for a damaged one; a row never fails the job."""

    def run(batches):
        for pdf in batches:
            out = []
            for path, content in pdf[["path", "content"]].itertuples(index=False, name=None):
                pages, status = [], "ok"
                try:
                    pages = list(parser(content))
                except PermissionError:
                    status = "encrypted"
                except Exception:
                    status = "damaged"
                if status == "ok":
                    text = any(s.get("text", "").strip() for p in pages for b in p.get("blocks", []) for x in b.get("lines", []) for s in x.get("spans", []))
                    status = "empty" if not pages else "ok" if text else "no_text"
                out.append((path, status, json.dumps(pages)))
            yield pd.DataFrame(out, columns=["doc_id", "status", "pages"])

    return contents.mapInPandas(run, "doc_id string, status string, pages string")


def density(pages: DataFrame, key: str = "doc_id", words: int = WORDS, chars: int = CHARS, words_a_page: float = WORDS_A_PAGE, chars_a_page: float = CHARS_A_PAGE) -> DataFrame:
    """Whether the pages (key, page, text) hold enough text: key, pages, words, chars, supported."""
    stripped = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)^\s+|\s+$", ""))
    n = F.when(stripped == "", 0).otherwise(F.size(F.split(stripped, r"(?U)\s+")))
    rows = pages.groupBy(key).agg(F.count("*").alias("pages"), F.sum(n).cast("long").alias("words"), F.sum(F.length(stripped)).cast("long").alias("chars"))
    few = (F.col("words") < words) & (F.col("chars") < chars)
    thin = (F.col("words") / F.col("pages") < words_a_page) & (F.col("chars") / F.col("pages") < chars_a_page)
    return rows.withColumn("supported", ~(few | thin))


def export(parts: DataFrame, folder: str, writer: Callable[[dict], tuple[str, bytes]], keep: str | None = None) -> DataFrame:
    """Write what ``writer`` makes of each row (a slice, an image, a table's clip) below a shared folder: path and a warning, if it
    failed, and a column that is kept. A repeated task writes the same names again."""

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                own = (row[keep],) if keep else ()
                try:
                    name, content = writer(row)
                    store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                    with store.open_output_stream(f"{root}/{name}") as sink:
                        sink.write(content)
                    out.append((*own, f"{folder}/{name}", None))
                except Exception as error:
                    out.append((*own, None, f"export_failed:{row.get('page')}:{row.get('ordinal')}:{type(error).__name__}"))
            yield pd.DataFrame(out, columns=[*([keep] if keep else []), "path", "warning"])

    return parts.mapInPandas(run, (f"{keep} string, " if keep else "") + "path string, warning string")


def asset_name(kind: str, suffix: str = "png"):
    """p%04d_img%02d.ext or p%04d_table%02d.png of page and ordinal."""
    return F.format_string(f"p%04d_{kind}%02d.{suffix}", "page", "ordinal")


def _each_pdf(files: DataFrame, schema: str, rows) -> DataFrame:
    """What ``rows`` yields for the bytes of each file, after its name; files that can't be read give nothing here
    (``open_documents`` says why)."""
    names = [x.strip().split()[0] for x in schema.split(", ")]

    def run(batches):
        for pdf_files in batches:
            out = []
            for path, content in pdf_files[["path", "content"]].itertuples(index=False, name=None):
                try:
                    out += [(path.rpartition("/")[2], *row) for row in rows(content)]
                except (ValueError, PermissionError, KeyError, TypeError, IndexError):
                    continue
            yield pd.DataFrame(out, columns=names)

    return files.mapInPandas(run, schema)


def pdf_layouts(files: DataFrame) -> DataFrame:
    """Page layouts (schemas.PAGE_LAYOUT) of PDF files (path, content), named by the file."""

    def rows(content):
        from quire.sources import pdf

        for n, page in enumerate(pdf.pages(content), start=1):
            yield from (tuple(row[1:]) for row in pages_of({"doc_id": "", "pages": [{**page, "page": n}]}))

    return _each_pdf(files, PAGE_LAYOUT, rows)


def pdf_contents(files: DataFrame) -> DataFrame:
    """Tables of contents (schemas.TOC) of PDF files."""

    def rows(content):
        from quire.sources import pdf

        for pos, (level, title, page) in enumerate(pdf.Pdf(content).contents(), start=1):
            yield pos, level, title, page

    return _each_pdf(files, TOC, rows)


def page_texts(layouts: DataFrame) -> DataFrame:
    """Plain text of laid-out pages, blocks apart: doc_id, page, text."""
    line = lambda x: F.array_join(F.transform(x["spans"], lambda s: F.coalesce(s["text"], F.lit(""))), "")
    block = lambda b: F.array_join(F.transform(b["lines"], line), "\n")
    return layouts.select("doc_id", "page", F.array_join(F.transform(F.filter("blocks", lambda b: b["type"] == 0), block), "\n\n").alias("text"))


def pdf_pages(files: DataFrame) -> DataFrame:
    """PDF files of slices as the extract phase takes them: slice_file, page, width, height, blocks, text, tables (none: lines that are
    drawn aren't looked at) and images under the names that ``pdf_images`` gives them."""
    from quire.schemas import SNAPSHOT

    pages = pdf_layouts(files)
    named = F.transform("images", lambda x, i: F.struct(F.format_string("assets/p%04d_img%02d.png", "page", i + 1).alias("asset_path"), x["bbox"].alias("bbox")))
    rows = pages.join(page_texts(pages), ["doc_id", "page"])
    return rows.select(F.col("doc_id").alias("slice_file"), "page", "width", "height", "blocks", "text", F.array().cast(f"array<{SNAPSHOT}>").alias("tables"), named.alias("images"))


def pdf_slices(files: DataFrame, slices: DataFrame, folder: str) -> DataFrame:
    """Write slices (doc_id, start_page, end_page, slice_file) of PDF files as files of their own: slice_file, path, warning."""

    def writer(row):
        from quire.sources import pdf

        return row["slice_file"], pdf.page_range(bytes(row["content"]), int(row["start_page"]), int(row["end_page"]))

    named = files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("doc_id"), "content")
    rows = slices.join(named, "doc_id")
    return export(rows.select("slice_file", "start_page", "end_page", "content", F.col("start_page").alias("page"), F.lit(0).alias("ordinal")), folder, writer, keep="slice_file")


def pdf_images(files: DataFrame, folder: str) -> DataFrame:
    """Write the images of PDF files below a folder for each file: path, warning."""

    def rows(content):
        from quire.sources import pdf

        yield from pdf.images(content)

    found = _each_pdf(files, "doc_id string, page int, ordinal int, suffix string, content binary", rows)
    named = found.withColumn("name", F.concat("doc_id", F.lit("/"), F.format_string("p%04d_img%02d.%s", "page", "ordinal", "suffix")))
    return export(named, folder, lambda row: (row["name"], bytes(row["content"])))

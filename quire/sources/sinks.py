"""What the phases leave behind: manifests that the next phase reads, reports, and files in a folder for each slice.

Manifests and reports are rows with the schemas of ``quire.schemas``; ``files`` and ``copied`` write bytes below a shared folder and
give a row for each file, with a warning where it failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire import schemas as S
from quire.functions import text as T
from quire.operators import merge
from quire.sources import layout

VERSION = "quire 1"
#: Longest name of a folder or file.
LONGEST = 240


def _listed(rows: DataFrame, keys: list[str], order: list[str], name: str, fields: list) -> DataFrame:
    """Rows of each key as one array in order."""
    one = F.struct(*order, F.struct(*fields).alias("x"))
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(one)), lambda r: r["x"]).alias(name))


def _now(at: str | None) -> Column:
    return F.lit(at) if at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")


def folder_name(order: Column, title: Column) -> Column:
    return F.concat(F.format_string("%03d-", order), T.fitted_name(T.safe_name(title), LONGEST))


def slice_manifests(slices: DataFrame, documents: DataFrame, at: str | None = None) -> DataFrame:
    """Planned slices (doc_id, pos, slice_file and the fields of a slice) and documents (doc_id, total_pages, fallback_level) to a
    manifest a document, as schemas.SLICE_MANIFEST."""
    fields = ["slice_file", "start_page", "end_page", (F.col("end_page") - F.col("start_page") + 1).alias("actual_pages"), F.col("title").alias("display_title"), "toc_level", "split_mode", "overlap_pages", "boundary_reason", "exception_type", "manual_review_required"]
    rows = _listed(slices, ["doc_id"], ["pos"], "slices", fields).join(documents, "doc_id")
    return rows.select(F.col("doc_id").cast("string").alias("source_file"), "total_pages", _now(at).alias("created_at"), F.lit(VERSION).alias("generator_version"), "fallback_level", "slices")


def extract_manifests(records: DataFrame, slices: DataFrame, at: str | None = None) -> DataFrame:
    """Records of the extract phase and slices (source_file, slice_number, slice_file) to a manifest a source, as
    schemas.EXTRACT_MANIFEST; a failed slice names no files."""
    folder = F.concat(F.format_string("%03d-", "slice_number"), T.fitted_name(T.safe_name(F.regexp_replace("slice_file", r"\.[^.]+$", "")), LONGEST))
    good = F.col("status") == "success"
    rows = slices.select("source_file", "slice_number", "slice_file").join(records, "slice_file").withColumn("folder", folder)
    fields = [
        "slice_file", F.when(good, F.concat("folder", F.lit("/content.json"))).alias("content_file"), F.when(good, F.concat("folder", F.lit("/"), "folder", F.lit(".md"))).alias("md_file"), "status",
        F.col("warning_count").cast("int").alias("warning_count"), "manual_review_required", F.lit(1).cast("long").alias("elapsed_ms"), "error_code", F.col("error_code").alias("error_message"),
    ]
    nested = _listed(rows, ["source_file"], ["slice_number"], "slices", fields)
    nested = nested.withColumn("slices", F.transform("slices", lambda s: s.withField("stage_timings", F.create_map().cast("map<string,long>"))))
    counts = rows.groupBy("source_file").agg(F.count("*").cast("int").alias("total_slices"), F.count_if(good).cast("int").alias("success_count"), F.count_if(F.col("status") == "failed").cast("int").alias("failed_count"), F.sum("warning_count").cast("int").alias("total_warnings"))
    return nested.join(counts, "source_file").select(F.lit("manifest.json").alias("source_manifest"), "source_file", _now(at).alias("created_at"), F.lit(VERSION).alias("generator_version"), F.lit("all").alias("scope"), "total_slices", "success_count", "failed_count", "total_warnings", F.lit(0).cast("long").alias("total_elapsed_ms"), "slices")


def review_reports(done: dict[str, DataFrame]) -> DataFrame:
    """Results of the format phase to a report a slice: doc_id, coverage, issues, fixes, passed, manual_review_required."""
    issues = _listed(done["issues"], ["doc_id"], ["issue_type", "node_ref", "message"], "issues", ["issue_type", "severity", "node_ref", "message", "auto_fixable"])
    fixes = _listed(done["fixes"], ["doc_id"], ["page", "fix_type", "node_ref"], "fixes", ["fix_type", "page", "node_ref"])
    rows = done["documents"].select("doc_id", "passed", "manual_review_required").join(done["coverage"], "doc_id", "left").join(issues, "doc_id", "left").join(fixes, "doc_id", "left")
    ratio = F.when(F.coalesce("expected", F.lit(0)) == 0, 1.0).otherwise(F.col("matched") / F.col("expected"))
    none = lambda c: F.coalesce(c, F.array().cast(rows.schema[c].dataType))
    return rows.select("doc_id", F.struct(F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("matched", F.lit(0)).alias("matched"), ratio.alias("ratio")).alias("coverage"), none("issues").alias("issues"), none("fixes").alias("fixes"), "passed", "manual_review_required")


def numbered(documents: DataFrame, source: Column | None = None) -> DataFrame:
    """Formatted slices of each source in the order of their pages, with order_index and folder."""
    rows = documents.withColumn("source_file", F.lit("") if source is None else source)
    place = F.row_number().over(W.partitionBy("source_file").orderBy("start_page", "doc_id"))
    rows = rows.withColumn("order_index", place)
    return rows.withColumn("folder", folder_name(F.col("order_index"), F.col("display_title")))


def format_manifests(rows: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """Numbered slices, and those that the phase before did not finish (source_file, slice_file, status), to a manifest a source, as
    schemas.FORMAT_MANIFEST."""
    fields = ["slice_file", "display_title", "order_index", "start_page", "end_page", "final_md_file", "review_report_file", "status", "manual_review_required"]
    own = rows.select("source_file", F.col("doc_id").cast("string").alias("slice_file"), "display_title", "order_index", "start_page", "end_page", F.concat("folder", F.lit("/final.md")).alias("final_md_file"), F.concat("folder", F.lit("/review_report.json")).alias("review_report_file"), F.lit("success").alias("status"), "manual_review_required")
    if skipped is not None:
        own = own.unionByName(skipped.select("source_file", "slice_file", "status", F.lit(False).alias("manual_review_required")), allowMissingColumns=True)
    nested = _listed(own, ["source_file"], ["order_index", "slice_file"], "slices", fields)
    return nested.select("source_file", F.lit("extract_manifest.json").alias("source_extract_manifest"), F.lit(VERSION).alias("generator_version"), F.size("slices").alias("total_slices"), "slices")


def merge_reports(merged: dict[str, DataFrame]) -> DataFrame:
    """Results of the merge phase to a report a book: status (failed if a slice is missing), sums, decisions and warnings."""
    books, decisions, warnings = merged["books"], merged["decisions"], merged["warnings"]
    gone = _listed(decisions, ["book"], ["right"], "decisions", ["right", "first_removed", "removed_count", "strategy", "source_page"])
    told = _listed(warnings, ["book"], ["warning_type"], "warnings", ["warning_type"])
    rows = books.select("book", "n_slices", "char_count").join(gone, "book", "left").join(told, "book", "left")
    kinds = F.transform(F.coalesce("warnings", F.array().cast(told.schema["warnings"].dataType)), lambda w: w["warning_type"])
    removed = F.aggregate(F.coalesce("decisions", F.array().cast(gone.schema["decisions"].dataType)), F.lit(0).cast("long"), lambda a, d: a + d["removed_count"])
    return rows.select("book", F.when(F.array_contains(kinds, "slice_missing"), "failed").otherwise("success").alias("status"), "n_slices", "char_count", removed.alias("removed_blocks"), "decisions", kinds.alias("warnings"))


def run_summary(merged: dict[str, DataFrame]) -> DataFrame:
    return merge.summary(merged["books"], merged["decisions"], merged["warnings"])


def files(rows: DataFrame, folder: str) -> DataFrame:
    """Write rows (name, a path below the folder, and content, a text) as files: path, warning."""
    return layout.export(rows.select("name", F.col("content").cast("binary").alias("content")), folder, lambda row: (row["name"], bytes(row["content"])))


def copied(rows: DataFrame, source: str, target: str) -> DataFrame:
    """Copy files (name, to: paths below the two folders): path, warning."""

    def content(row):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(source if "://" in source else f"file://{source}")
        with store.open_input_stream(f"{root}/{row['name']}") as stream:
            return row["to"], stream.read()

    return layout.export(rows.select("name", "to"), target, content)


def missing_files(rows: DataFrame, folder: str, column: str = "slice_file") -> DataFrame:
    """Rows whose file isn't below the folder: the column and error_code. Names are listed by Spark; no file is read."""
    there = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name")).distinct()
    # listed paths are encoded, so names are compared in that form
    name = F.replace(F.url_encode(column), F.lit("+"), F.lit("%20"))
    listed = there.select(F.replace(F.url_encode(F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B")))), F.lit("+"), F.lit("%20")).alias("name")).distinct()
    return rows.withColumn("name", name).join(listed, "name", "left_anti").select(column, F.lit("MISSING_FILE").alias("error_code"))


SCHEMAS = {"slice": S.SLICE_MANIFEST, "extract": S.EXTRACT_MANIFEST, "format": S.FORMAT_MANIFEST}

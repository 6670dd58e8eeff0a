"""Manifests between the phases: JSON read with fixed schemas, checked as tables, and written back.

Checks return rows (a file or slice and an error code); nothing is raised for one bad slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire import schemas as S

KINDS = {"slice": S.SLICE_MANIFEST, "extract": S.EXTRACT_MANIFEST, "format": S.FORMAT_MANIFEST, "content": S.CONTENT}
REQUIRED = {
    "slice": ["source_file", "total_pages", "slices"],
    "extract": ["source_manifest", "source_file", "slices"],
    "format": ["source_file", "total_slices", "slices"],
}


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Manifests of one kind, many files at once; a file that isn't JSON has its text in _corrupt_record."""
    return spark.read.schema(KINDS[kind] + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def missing_keys(manifests: DataFrame, kind: str) -> DataFrame:
    """Required fields that a manifest lacks."""
    lacks = F.array_except(F.array(*map(F.lit, REQUIRED[kind])), F.filter(F.array(*(F.when(F.col(c).isNotNull(), c) for c in REQUIRED[kind])), lambda x: x.isNotNull()))
    return manifests.select("source_file", F.explode(lacks).alias("field"))


def slices(manifests: DataFrame) -> DataFrame:
    """One row a slice with its number, from 1."""
    return manifests.select("source_file", F.posexplode("slices").alias("at", "s")).select("source_file", (F.col("at") + 1).alias("slice_number"), "s.*")


def slice_errors(rows: DataFrame) -> DataFrame:
    """Slices with a bad page range or overlap pages outside of it: slice_file, error_code."""
    outside = F.exists(F.coalesce("overlap_pages", F.array().cast("array<int>")), lambda p: (p < F.col("start_page")) | (p > F.col("end_page")))
    code = F.when(F.coalesce("slice_file", F.lit("")) == "", "MISSING_SLICE").when(F.coalesce(F.col("start_page") <= 0, F.lit(True)), "BAD_START").when(F.coalesce(F.col("end_page") < F.col("start_page"), F.lit(True)), "BAD_RANGE").when(outside, "BAD_OVERLAP")
    return rows.select("slice_file", code.alias("error_code")).where("error_code IS NOT NULL")


def succeeded(rows: DataFrame) -> DataFrame:
    """Slices that the phase finished, in order."""
    return rows.where("status = 'success'")


def order_errors(rows: DataFrame) -> DataFrame:
    """Finished slices that share a place in the order: source_file, order_index, error_code."""
    n = F.count("*").over(W.partitionBy("source_file", "order_index"))
    return succeeded(rows).withColumn("n", n).where("n > 1").select("source_file", "order_index", F.lit("DUPLICATE_ORDER").alias("error_code")).distinct()


def without_slices(manifests: DataFrame) -> DataFrame:
    """Manifests of which no slice was finished."""
    ok = F.exists(F.coalesce("slices", F.array().cast(manifests.schema["slices"].dataType)), lambda s: s["status"] == "success")
    return manifests.where(~F.coalesce(ok, F.lit(False))).select("source_file", F.lit("NO_SUCCESSFUL_SLICE").alias("error_code"))


def rollup(rows: DataFrame) -> DataFrame:
    """Counts by status, sum of warnings, whether any slice needs review. Slices skipped because of the phase before aren't failures."""
    return rows.agg(
        F.count("*").alias("total_slices"), F.count_if(F.col("status") == "success").alias("success_count"), F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.count_if(F.col("status") == "skipped_upstream_failed").alias("skipped_count"), F.coalesce(F.sum("warning_count"), F.lit(0)).alias("total_warnings"), F.coalesce(F.max("manual_review_required"), F.lit(False)).alias("manual_review_required"),
    )


def failure(rows: DataFrame, code: str, message: str) -> DataFrame:
    """Rows of slices as failures, which always need review."""
    return rows.select("slice_file", F.lit("failed").alias("status"), F.lit(0).alias("warning_count"), F.lit(True).alias("manual_review_required"), F.lit(code).alias("error_code"), F.lit(message).alias("error_message"))


def timings(stages: DataFrame) -> DataFrame:
    """stage_timings (map) with a total, each at least 1."""
    floor = F.transform_values("stage_timings", lambda _, v: F.greatest(v, F.lit(1).cast("long")))
    total = F.aggregate(F.map_values(floor), F.lit(0).cast("long"), lambda a, x: a + x)
    return stages.withColumn("stage_timings", F.map_concat(floor, F.create_map(F.lit("total"), total)))


def write(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines; an output that exists is an error unless it may be replaced."""
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_texts(df: DataFrame, path: str, name: str, text: str, overwrite: bool = False) -> None:
    """One text file a row, below a folder for its name."""
    df.select(F.col(name).alias("name"), F.col(text).alias("value")).write.mode("overwrite" if overwrite else "errorifexists").partitionBy("name").option("lineSep", "\n").text(path)

"""The corpus pipeline: five stages from raw documents to token counts.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.llm import bpe, jaccard, langid, linededup, mixing
from quire.llm.common import remove, shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those of which no language holds half of the letters."""
    return langid.stage(spark, docs, sf_dir)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of templates that recur across documents, and documents of which nothing is left."""
    return linededup.stage(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates: the one with the smallest id. Null and empty texts are classes of their
    own, ties go to the smallest id, and of repeated rows one stays."""
    return jaccard.stage(spark, docs, sf_dir)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix draws a document. Null and empty texts are never drawn; a null source is a source of its own;
    repeated rows are drawn alike."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row. Workers that ran the stages before hold memory already, so they remember less here."""
    return bpe.encode(docs, keep_ids=False, entries=150_000)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("bpe", tokenize),
]

#: Language ID, the forest and BPE are not expressible in SQL; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents; what a stage wrote is deleted once the next has been written."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        if k:
            remove(spark, before)
        before = f"{folder}/{k}-{name}"
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}-{name}")
    return docs

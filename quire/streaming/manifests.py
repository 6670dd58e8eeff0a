"""Documents that arrive over time: manifests as a stream, each micro-batch run through a batch phase. Slices do not depend on each
other, so this keeps no state; an output folder a batch makes a repeated batch harmless."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.sources.manifests import KINDS


def watch(spark: SparkSession, path: str, kind: str, work: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, once: bool = True):
    """Run ``work`` on the manifests of each micro-batch and write its rows as Parquet below ``output``."""
    stream = spark.readStream.schema(KINDS[kind]).option("multiLine", True).json(path)

    def batch(df: DataFrame, number: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

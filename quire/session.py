"""Sessions with the settings that the library expects."""

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "quire", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC; settings already given by the cluster stay."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df`` on a plan of their own: a checkpoint in the folder that the cluster names, so that what several results
    share is computed once and survives lost executors. Only a session on one
    machine gets a folder of its own without that setting."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="quire-checkpoint-"))
    return df.checkpoint(eager=True)

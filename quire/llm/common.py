"""Helpers shared by the corpus operators: shared storage, lineage cuts and Arrow mapping."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Only a session on one machine gets a folder of its own
    without that setting; on a cluster a local folder would lose rows, so it is an error there."""
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known is None:
        configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="quire-checkpoint-"))
        known = context.getCheckpointDir()
    return known.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the plan is cut and the rows survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows as a compressed table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` wrote, once all that reads it has been checkpointed."""
    remove(df.sparkSession, df.stored_at)


def light(df: DataFrame, rows: int = 1_000_000, weight: Column | None = None) -> DataFrame:
    """A checkpointed table of a few short columns as a broadcast side if it has at most ``rows`` rows, or at most so much
    ``weight`` in all where rows hold arrays; else as it is, for a shuffle join that adaptive execution can split."""
    if weight is None:
        return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
    return F.broadcast(df) if (df.agg(F.sum(weight)).first()[0] or 0) <= rows else df


def arrow_map(df: DataFrame, schema: str | T.StructType, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[list]]) -> DataFrame:
    """mapInArrow where ``rows`` yields lists of columns in the order of ``schema``."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return df.mapInArrow(ArrowRows(rows, kind), kind)


class ArrowRows:
    """Picklable adapter from column lists to record batches."""

    def __init__(self, rows, kind: T.StructType):
        self.rows, self.kind = rows, kind

    def __call__(self, batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.kind)
        for columns in self.rows(batches):
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, target, strict=True)], schema=target)


_caches: dict[str, Callable[[], None]] = {}


def remembers(owner: str, forget: Callable[[], None]) -> None:
    """Spark uses Python workers again, so what operators remember in a worker would add up: when one begins to fill its cache, the
    others' are emptied and their memory is given back."""
    others = [clear for other, clear in _caches.items() if other != owner]
    for clear in others:
        clear()
    _caches[owner] = forget
    if others:
        give_back()


def give_back() -> None:
    """Freed memory to the operating system, where the C library knows how."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches into pieces of about ``max_bytes``, one row at least, to bound Python memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)

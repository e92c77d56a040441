"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few numbers or short texts up to which a table is broadcast (about 64 MB).
BROADCAST_ROWS = 2_000_000
#: Bytes of an Arrow batch of texts: a worker holds a few batches, whatever the texts' lengths.
BATCH_BYTES = 8 << 20


def _own_folder(spark: SparkSession) -> str:
    """The application's folder below the cluster's checkpoint folder.

    That is the one that ``spark.checkpoint.dir`` names. Only where a
    local session names none (bench, tests) a temporary folder is set; on a
    cluster that is refused, as executors don't see the driver's folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tariffloom-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/tariffloom/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove all that this application has written in the shared folder; results that still read it are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound the session's Arrow batches by bytes; a lower bound that is set already stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > most:
        spark.conf.set(key, str(most))


@contextmanager
def light_task(forget: Callable[[], None] | None = None) -> Iterator[None]:
    """A task that fills caches without cycles: they are not walked for any, and nothing large outlives the task.

    Workers are reused by later stages, so collection is turned on again,
    ``forget`` empties the caches, and Arrow gives its memory back.
    """
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()
        if forget is not None:
            forget()
        pa.default_memory_pool().release_unused()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: executors lost later cost no recomputation of ``df``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """Broadcast a table of few numbers a row, if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

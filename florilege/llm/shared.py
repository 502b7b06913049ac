"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; only in local mode (tests) make a folder where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder; later reads survive lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def materialize_table(df: DataFrame) -> DataFrame:
    """The same as a Parquet table in that folder: for many rows, of which few columns are read at a time.

    The folder's owner clears it, as with checkpoints of jobs that ended.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark deletes the shuffle files of plans that nothing refers to any more only then, and those of many rounds fill the executors' disks."""
    spark._jvm.System.gc()


def redealt(df: DataFrame) -> DataFrame:
    """``df`` dealt anew in turn: a join with an aggregate can be split where a key is skewed only if both its sides are plain shuffles."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def give_back() -> None:
    """Return freed memory of a Python worker to the system: workers live on, and what they hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_held: list[Callable[[], None]] = []


def held(forget: Callable[[], None]) -> None:
    """Register how a cache of this worker process is emptied."""
    _held.append(forget)


def release() -> None:
    """At a task's end: empty all caches, so that a worker that goes on to another operator doesn't hold those of the last."""
    for forget in _held:
        forget()
    give_back()

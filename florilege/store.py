"""The folder that driver and executors share: results computed once, and tables that change together."""

from __future__ import annotations

import json
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; only in local mode (tests) a new folder where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` written into the shared folder: whatever reads it gets the same rows, lost executors or not.

    Spark deletes the files with the last reader where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def table_once(df: DataFrame) -> DataFrame:
    """The same as a Parquet table: for many rows, of which few columns or rows are read at a time.

    The shuffles behind it are forgotten.  The folder's owner clears it, as with
    checkpoints of jobs that ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    forget_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def forget_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: only then Spark deletes the shuffle files of plans that nothing refers to any more."""
    spark._jvm.System.gc()


class StaleError(Exception):
    """Another writer has committed since the snapshot was read."""


class TableSet:
    """Several tables that change together or not at all.

    A snapshot is a numbered manifest that names a folder for each table.  A
    commit writes its tables into folders of its own, then creates the manifest
    behind the one it has read, which only one writer can: the store's
    exclusive creation is the compare-and-set.  The loser's folders are
    deleted, and all tables are as they were.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, path: str):
        own = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return own, own.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """Number of the last snapshot; 0 if there is none."""
        path, store = self._path(f"{self.folder}/manifests")
        names = [x.getPath().getName() for x in store.listStatus(path)] if store.exists(path) else []
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def _manifest(self, version: int) -> dict[str, str]:
        rows = self.spark.read.text(f"{self.folder}/manifests/{version:012d}.json", wholetext=True).collect()  # one small file
        return json.loads(rows[0][0])

    def read(self, version: int | None = None) -> tuple[int, dict[str, DataFrame]]:
        """A snapshot's number and tables, the last one's if none is named."""
        version = self.version() if version is None else version
        return version, {name: self.spark.read.parquet(path) for name, path in (self._manifest(version) if version else {}).items()}

    def commit(self, read: int, tables: dict[str, DataFrame]) -> int:
        """The new snapshot's number: ``tables`` replaced, the others as in snapshot ``read``.  StaleError if that isn't the last any more."""
        base = f"{self.folder}/data/{uuid.uuid4().hex}"
        try:
            if self.version() != read:
                raise StaleError(f"snapshot {read} is not the last one")
            for name, df in tables.items():
                df.write.option("compression", "zstd").parquet(f"{base}/{name}")
                forget_shuffles(self.spark)  # those of one table don't lie beside the next one's
            now = (self._manifest(read) if read else {}) | {name: f"{base}/{name}" for name in tables}
            path, store = self._path(f"{self.folder}/manifests/{read + 1:012d}.json")
            try:
                out = store.create(path, False)
            except Py4JJavaError as e:
                if store.exists(path):
                    raise StaleError(f"snapshot {read} is not the last one") from e
                raise
            out.write(json.dumps(now).encode())
            out.close()
        except Exception:
            path, store = self._path(base)
            store.delete(path, True)
            raise
        return read + 1

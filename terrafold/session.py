"""Sending the package to Python workers, and cutting long plans."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Rows of a batch that goes to a Python worker.
ROWS = 2048
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once for each Spark context.

    Spark's own file server carries the archive, so nothing has to be
    installed on the executors and no folder has to be shared.  Batches to the
    workers get ``ROWS`` rows where the session has Spark's default of 10,000,
    which whole texts make large in the executor and again in the worker.
    """
    if spark.conf.get(_ROWS, "10000") == "10000":
        spark.conf.set(_ROWS, str(ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_terrafold_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="terrafold-code-")) / "terrafold.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._terrafold_shipped = True


def _shared(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; only a local master (tests) gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="terrafold-")
    return base


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from the checkpoint folder, so that plans on it start anew."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(_shared(df.sparkSession))
    return df.checkpoint()


class Stage:
    """Tables written as Parquet below the shared folder; the shuffle files of each go when it is written.

    ``drop`` removes a table that is not read again; the folder goes with the application.
    """

    _CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{_shared(spark)}/terrafold-{uuid.uuid4().hex}"
        self._files(self.root, lambda files, path: (files.mkdirs(path), files.deleteOnExit(path)))

    def _files(self, name: str, do) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        do(path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(self._CLEAN, None)
        self.spark.conf.set(self._CLEAN, "true")
        try:
            df.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        finally:
            if before is None:
                self.spark.conf.unset(self._CLEAN)
            else:
                self.spark.conf.set(self._CLEAN, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        self._files(f"{self.root}/{name}", lambda files, path: files.delete(path, True))

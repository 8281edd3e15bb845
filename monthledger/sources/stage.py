"""Intermediate tables with an owner.

A ``Stage`` is a folder of its own below the folder that all executors share
(``spark.checkpoint.dir``). A table written to it is read back as files, so the
lineage ends there, lost executors do not bring the work back, and every reader
sees the same rows. Leaving the ``with`` block, or ``close``, deletes the
folder; one that is never closed goes when the driver's file system closes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def shared_base(spark: SparkSession) -> str:
    """The shared folder; only a local session without one gets its own."""
    base = spark.conf.get(SHARED_FOLDER, None) or spark.sparkContext.getConf().get(SHARED_FOLDER)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_FOLDER} to a folder that all executors share")
        base = tempfile.gettempdir()
    return base.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's (file system, path) of ``path``, whatever its scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Stage:
    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.path = f"{(base or shared_base(spark)).rstrip('/')}/monthledger-{uuid.uuid4().hex}"
        self._fs, self._folder = file_system(spark, self.path)
        self._fs.mkdirs(self._folder)
        self._fs.deleteOnExit(self._folder)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as the stage's table ``name`` and read it back."""
        path = f"{self.path}/{name}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        self._fs.delete(self._folder, True)

    def __enter__(self) -> "Stage":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

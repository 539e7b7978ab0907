"""Writing intermediate tables to the cluster's shared folder.

A written Parquet table cuts lineage like a checkpoint, is computed once, survives the loss of executors and can be
read back with column pruning and exact size statistics.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch for removing a query's shuffle files when it ends; versions that don't know it keep them longer.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master that names none."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="ledgerloom-")
    return _local_folder.name


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go when it ends: what it wrote is read from then on, never the query again.

    Otherwise they stay until the driver's garbage collection finds them, and a process of many steps holds them all.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


class Stage:
    """One run's folder below the shared folder; each table is written once and read back."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{name}"
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in names:
            path = hadoop.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

"""Intermediate tables in the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from playmart import files

SETTING = "spark.checkpoint.dir"
_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="playmart-")
    return _local_root


class Scratch:
    """One run's folder of written intermediate tables.

    A written table fixes row order and any generated value, and an executor
    lost later re-reads it instead of recomputing what led to it. The folder is
    removed by :meth:`clean`, or else when the driver exits.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.root = f"{shared_root(spark)}/playmart-{label}-{uuid.uuid4().hex}"
        files.make_temporary(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def bytes(self, name: str) -> int:
        return files.total_bytes(self.spark, self.path(name))

    def drop(self, name: str) -> None:
        files.delete(self.spark, self.path(name))

    def clean(self) -> None:
        files.delete(self.spark, self.root)

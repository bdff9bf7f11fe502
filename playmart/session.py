"""Sessions for the command line, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings the plans count on. Skewed partitions are split from 64 MB
# on: copies of a hot row compress so well that the default is reached late.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def submitted_session() -> SparkSession:
    """The session of a submitted job; what the submitter set stays as it is."""
    spark = SparkSession.builder.appName("playmart").getOrCreate()
    chosen = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session without a web page."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("playmart")
    fixed = {
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**fixed, **SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Key reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count ``n``.

    Primary keys are not enforced, so duplicates are legal; this reports them
    and removes nothing. The count is combined map-side before the shuffle, so
    one hot key costs one row per task.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)

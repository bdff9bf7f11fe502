"""Write-time constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.schemas import NOT_NULL


def not_null(df: DataFrame, column: str, table: str) -> Column:
    """``column`` unchanged; evaluating a NULL fails the job."""
    kind = df.schema[column].dataType
    failure = F.raise_error(F.lit(f"NOT NULL violated: {table}.{column}")).cast(kind)
    return F.coalesce(F.col(column), failure).alias(column)


def enforce_not_null(df: DataFrame, table: str) -> DataFrame:
    """``df`` with every not-null column of ``table`` guarded.

    Parquet tables accept NULL into NOT NULL columns, so the check is part of
    the written projection. It belongs in the write path only: in a view the
    optimizer may prune a guard together with its unused column.
    """
    guarded = set(NOT_NULL.get(table, ()))
    return df.select(*[not_null(df, c, table) if c in guarded else F.col(c) for c in df.columns])

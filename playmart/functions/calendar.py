"""Epoch milliseconds to wall-clock time, and the calendar parts of a time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_timestamp(millis: str) -> Column:
    """Whole-second TIMESTAMP_NTZ of an epoch-millisecond column.

    ``div`` truncates toward zero, so milliseconds are dropped. Adding an
    interval to an NTZ literal keeps the result free of the session time zone.
    """
    return F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + (`{millis}` div 1000) * interval '1' second")


def calendar_parts(start_time: str = "start_time") -> list[Column]:
    """hour, day, ISO week, month, calendar year and weekday (0 = Sunday)."""
    t = F.col(start_time)
    return [
        F.hour(t).alias("hour"),
        F.dayofmonth(t).alias("day"),
        F.weekofyear(t).alias("week"),
        F.month(t).alias("month"),
        F.year(t).alias("year"),
        (F.dayofweek(t) - 1).alias("weekday"),
    ]

"""Stand-ins for the two staging tables, derived from the parquet test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.schemas import PLAY_PAGE, column_types, numeric_type

PLAY_EVENT = "view"

# Columns used of each test table. A given schema saves the footer-reading job
# that inference runs per table and query.
SCHEMAS = {
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_type string, p_size int, p_retailprice double",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _epoch_millis(ts: str) -> Column:
    """Floored epoch milliseconds of a TIMESTAMP_NTZ, whatever the session zone.

    ``div`` truncates toward zero, so it counts from year 1, where every time is
    positive, and then shifts to 1970.
    """
    return F.expr(f"({ts} - timestamp_ntz'0001-01-01 00:00:00') div interval '0.001' second - 62135596800000")


def _part_key(props: str) -> Column:
    """The number under ``k``. A pattern is several times faster than parsing."""
    return F.nullif(F.regexp_extract(props, r'"k"\s*:\s*(\d+)', 1), F.lit("")).cast("bigint")


def _artist() -> Column:
    """Sixty neighbouring parts share an artist."""
    return F.concat(F.lit("Artist "), F.expr("p_partkey div 60").cast("string"))


def _title() -> Column:
    """Three neighbouring parts share a title, so each play matches three songs."""
    return F.concat(F.lit("Title "), F.expr("p_partkey div 3").cast("string"))


def _typed(values: dict[str, Column], table: str) -> list[Column]:
    """All columns of ``table`` in order and type; those without a value are NULL."""
    return [values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in column_types(table)]


def staging_events(spark: SparkSession, sf_dir: str, plays_only: bool = False) -> DataFrame:
    """``events`` joined to its user, the user's nation and the played part.

    ``plays_only`` restates the play-page filter on the stored event type, ahead
    of the computed ``page``, so that it reaches the parquet scan. It keeps every
    row whose page is the play page; callers still filter on ``page``.

    No join is hinted: sizes vary with the data, so Catalyst broadcasts a side
    only when its measured size allows it, and adaptive execution splits hot
    users and hot parts in the sort-merge form.
    """
    events = _table(spark, sf_dir, "events")
    if plays_only:
        events = events.filter(F.col("event_type").isin(PLAY_EVENT, PLAY_PAGE))
    events = events.withColumn("k", _part_key("props"))
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    part = _table(spark, sf_dir, "part")
    joined = (
        events.join(customer, events.user_id == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(part, events.k == part.p_partkey)
    )
    values = {
        "artist": _artist(),
        "firstName": F.col("c_name"),
        "gender": F.when(F.col("c_custkey") % 10 == 7, None).when(F.col("c_custkey") % 2 == 0, "F").otherwise("M"),
        "lastName": F.col("c_mktsegment"),
        "level": F.when(F.col("c_custkey") % 13 == 0, None).when(F.col("value") >= 20, "paid").otherwise("free"),
        "location": F.col("n_name"),
        "page": F.when(F.col("event_type") == PLAY_EVENT, PLAY_PAGE).otherwise(F.col("event_type")),
        "sessionId": F.col("user_id"),
        "song": _title(),
        "ts": _epoch_millis("ts"),
        "userAgent": F.col("event_type"),
        "userId": F.when(F.col("event_type") == "error", None).otherwise(F.col("user_id")),
    }
    return joined.select(*_typed(values, "staging_events"))


def staging_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One staged song per part; three neighbouring parts share a title."""
    values = {
        "num_songs": F.lit(1),
        "artist_id": F.concat(F.lit("AR"), F.expr("p_partkey div 60").cast("string")),
        "artist_location": F.col("p_type"),
        "artist_name": _artist(),
        "song_id": F.concat(F.lit("SO"), F.col("p_partkey").cast("string")),
        "title": _title(),
        "duration": F.col("p_retailprice").cast(numeric_type()),
        "year": F.col("p_size"),
    }
    return _table(spark, sf_dir, "part").select(*_typed(values, "staging_songs"))

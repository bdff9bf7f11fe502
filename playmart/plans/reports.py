"""The usage reports, over stored tables and straight from staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions import epoch_to_timestamp
from playmart.operators.lookup import BROADCAST_BYTES, measured_bytes
from playmart.plans.star import play_events


def count_distinct_ids(df: DataFrame, by: str, ids: str, name: str) -> DataFrame:
    """Exact distinct count of integer ids per group, NULL ids aside.

    Each group's ids become bitmaps of one bucket of neighbouring ids each. A dense
    key in file order fills few buckets per task, so what is shuffled is a row for
    each group, bucket and task rather than one for each id.
    """
    buckets = (
        df.groupBy(by, F.bitmap_bucket_number(ids).alias("__bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce(ids, F.lit(0)))).alias("__bits"))
    )
    counted = F.when(F.col("__bucket").isNull(), F.lit(0)).otherwise(F.bitmap_count("__bits"))
    return buckets.groupBy(by).agg(F.sum(counted).alias(name))


def plays_by_hour(
    songplays: DataFrame, time: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Distinct plays per hour of day: fact joined to the time dimension.

    Appended loads repeat rows of ``time``. The distinct count hides that, so
    dropping the repeats first changes nothing but the size of the join. Rows of
    ``time`` that measure at most ``broadcast_bytes``, repeats included, spare the fact
    a shuffle; their measure needs no distinct.
    """
    rows = time.select("start_time", "hour")
    hours = rows.distinct()
    if measured_bytes(rows) <= broadcast_bytes:
        hours = F.broadcast(hours)
    timed = songplays.select("start_time", "songplay_id").join(hours, "start_time")
    return count_distinct_ids(timed, "hour", "songplay_id", "song_plays").orderBy("hour")


def plays_by_level(songplays: DataFrame) -> DataFrame:
    """Distinct plays per subscription level; NULL is a level of its own."""
    return count_distinct_ids(songplays, "level", "songplay_id", "song_plays")


def users_by_gender(users: DataFrame) -> DataFrame:
    """Distinct users per gender; a user recorded under two counts in each."""
    return users.groupBy("gender").agg(F.count_distinct("user_id").alias("users"))


def _count_plays(events: DataFrame, songs: DataFrame, by: Column, name: str) -> DataFrame:
    """Plays per ``by``, counted without building the fact.

    Every play-song pair has its own songplay_id, so distinct ids are pairs.
    Both sides are counted per artist and title first and the counts are
    multiplied: a hot song meets the join as one row per group and side, and no
    pair is ever produced.
    """
    plays = (
        events.filter(F.col("artist").isNotNull() & F.col("song").isNotNull())
        .groupBy("artist", "song", by.alias(name))
        .agg(F.count(F.lit(1)).alias("plays"))
    )
    staged = (
        songs.filter(F.col("artist_name").isNotNull() & F.col("title").isNotNull())
        .groupBy(F.col("artist_name").alias("artist"), F.col("title").alias("song"))
        .agg(F.count(F.lit(1)).alias("staged"))
    )
    return (
        plays.join(staged, ["artist", "song"])
        .groupBy(name)
        .agg(F.sum(F.col("plays") * F.col("staged")).alias("song_plays"))
    )


def plays_by_hour_from_staging(events: DataFrame, songs: DataFrame) -> DataFrame:
    """Same result as :func:`plays_by_hour` over freshly built tables.

    The time dimension holds every second of the fact exactly once, so its join
    only drops plays without a time.
    """
    timed = play_events(events).filter(F.col("ts").isNotNull())
    return _count_plays(timed, songs, F.hour(epoch_to_timestamp("ts")), "hour").orderBy("hour")


def plays_by_level_from_staging(events: DataFrame, songs: DataFrame) -> DataFrame:
    """Same result as :func:`plays_by_level` over a freshly built fact."""
    return _count_plays(play_events(events), songs, F.col("level"), "level")


def users_by_gender_from_staging(events: DataFrame) -> DataFrame:
    """Same result as :func:`users_by_gender` over freshly built users.

    Distinct ids per gender need only those two columns of the dimension.
    """
    return (
        play_events(events)
        .filter(F.col("userId").isNotNull())
        .groupBy("gender")
        .agg(F.count_distinct("userId").alias("users"))
    )

"""Builders of the fact and dimension tables. Frames in, frames out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions import calendar_parts, epoch_to_timestamp
from playmart.operators import Scratch, broadcast_within, dense_ids
from playmart.operators.lookup import BROADCAST_BYTES
from playmart.schemas import PLAY_PAGE


SONG_KEYS = ["artist_name", "title", "song_id", "artist_id"]


def play_events(events: DataFrame) -> DataFrame:
    """Events of the play page; exact match, a NULL page is dropped."""
    return events.filter(F.col("page") == PLAY_PAGE)


def match_songs(events: DataFrame, songs: DataFrame, ignore_trailing_blanks: bool = False) -> DataFrame:
    """Inner join of events to staged songs on artist name and title.

    A NULL or unknown artist or title drops the event; several staged songs
    under one artist and title each give a row. The match is exact, or blind to
    trailing blanks on request.

    Without a hint on ``songs`` Catalyst broadcasts them when their size allows
    it; otherwise adaptive execution splits the partition of a hot song.
    """
    keys = songs.select(*SONG_KEYS)
    left, right = [events["artist"], events["song"]], [keys["artist_name"], keys["title"]]
    if ignore_trailing_blanks:
        left, right = [F.rtrim(c) for c in left], [F.rtrim(c) for c in right]
    return events.join(keys, (left[0] == right[0]) & (left[1] == right[1]))


def songplay_rows(events: DataFrame, songs: DataFrame, ignore_trailing_blanks: bool = False) -> DataFrame:
    """The fact without its surrogate key: one row per play and matching song."""
    return match_songs(play_events(events), songs, ignore_trailing_blanks).select(
        epoch_to_timestamp("ts").alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
    )


def build_songplays(
    events: DataFrame,
    songs: DataFrame,
    scratch: Scratch | None = None,
    start: int | Callable[[int], int] = 0,
    id_type: str = "bigint",
    ignore_trailing_blanks: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The fact, numbered from ``start`` in the order of all its columns (:func:`dense_ids`).

    Songs that measure at most ``broadcast_bytes`` are broadcast, so that plays
    are matched where they are read, and a hot song is spread as its plays are.

    The key is a bigint: a fact of the intended size outgrows 31 bits. Pass
    ``id_type="int"`` for the narrower type, which fails on overflow.
    """
    keys = broadcast_within(songs.select(*SONG_KEYS), broadcast_bytes)
    rows = songplay_rows(events, keys, ignore_trailing_blanks)
    scratch = scratch or Scratch(rows.sparkSession, "songplays")
    return dense_ids(rows, "songplay_id", scratch, start, id_type)


def build_users(events: DataFrame) -> DataFrame:
    """Distinct user descriptions; a user whose level changed has two rows."""
    return (
        play_events(events)
        .filter(F.col("userId").isNotNull())
        .select(
            F.col("userId").alias("user_id"),
            F.col("firstName").alias("first_name"),
            F.col("lastName").alias("last_name"),
            "gender",
            "level",
        )
        .distinct()
    )


def build_songs(songs: DataFrame) -> DataFrame:
    return (
        songs.filter(F.col("song_id").isNotNull())
        .select("song_id", "title", "artist_id", "year", "duration")
        .distinct()
    )


def build_artists(songs: DataFrame) -> DataFrame:
    """Distinct artist descriptions; one id may have several."""
    return (
        songs.filter(F.col("artist_id").isNotNull())
        .select(
            "artist_id",
            F.col("artist_name").alias("name"),
            F.col("artist_location").alias("location"),
            F.col("artist_latitude").alias("latitude"),
            F.col("artist_longitude").alias("longitude"),
        )
        .distinct()
    )


def build_time(events: DataFrame) -> DataFrame:
    """Distinct seconds of all play events, matched to a song or not.

    The parts are functions of the second, so the distinct shuffles one column
    and the parts are derived after it.
    """
    return (
        play_events(events)
        .select(epoch_to_timestamp("ts").alias("start_time"))
        .distinct()
        .select("start_time", *calendar_parts())
    )

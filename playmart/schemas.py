"""Table contracts: columns, types, keys and not-null rules."""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names, types, keys and not-null rules are the
# contract of the star schema and must stay exactly as they are.
# "numeric" stands for a decimal whose precision depends on the numeric mode.
COLUMNS = {
    "staging_events": [
        ("artist", "string"),
        ("auth", "string"),
        ("firstName", "string"),
        ("gender", "string"),
        ("iteminSession", "int"),
        ("lastName", "string"),
        ("length", "numeric"),
        ("level", "string"),
        ("location", "string"),
        ("method", "string"),
        ("page", "string"),
        ("registration", "numeric"),
        ("sessionId", "int"),
        ("song", "string"),
        ("status", "int"),
        ("ts", "bigint"),
        ("userAgent", "string"),
        ("userId", "int"),
    ],
    "staging_songs": [
        ("num_songs", "int"),
        ("artist_id", "string"),
        ("artist_latitude", "numeric"),
        ("artist_longitude", "numeric"),
        ("artist_location", "string"),
        ("artist_name", "string"),
        ("song_id", "string"),
        ("title", "string"),
        ("duration", "numeric"),
        ("year", "int"),
    ],
    "songplays": [
        ("songplay_id", "bigint"),
        ("start_time", "timestamp_ntz"),
        ("user_id", "int"),
        ("level", "string"),
        ("song_id", "string"),
        ("artist_id", "string"),
        ("session_id", "int"),
        ("location", "string"),
        ("user_agent", "string"),
    ],
    "users": [
        ("user_id", "int"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("gender", "string"),
        ("level", "string"),
    ],
    "songs": [
        ("song_id", "string"),
        ("title", "string"),
        ("artist_id", "string"),
        ("year", "int"),
        ("duration", "numeric"),
    ],
    "artists": [
        ("artist_id", "string"),
        ("name", "string"),
        ("location", "string"),
        ("latitude", "numeric"),
        ("longitude", "numeric"),
    ],
    "time": [
        ("start_time", "timestamp_ntz"),
        ("hour", "int"),
        ("day", "int"),
        ("week", "int"),
        ("month", "int"),
        ("year", "int"),
        ("weekday", "int"),
    ],
}
PRIMARY_KEY = {
    "songplays": "songplay_id",
    "users": "user_id",
    "songs": "song_id",
    "time": "start_time",
}
NOT_NULL = {
    "songplays": ["songplay_id", "start_time", "user_id", "session_id"],
    "users": ["user_id"],
    "songs": ["song_id", "title", "artist_id"],
    "artists": ["name"],
    "time": ["start_time"],
}
SORT_KEY = {
    "staging_events": "sessionId",
    "staging_songs": "song_id",
    "songplays": "start_time",
    "users": "user_id",
    "songs": "song_id",
    "artists": "artist_id",
    "time": "start_time",
}
PLAY_PAGE = "NextSong"
NUMERIC = {"exact": "decimal(23,5)", "ddl": "decimal(18,0)"}
# End of the fixed values.

# Columns by which single rows are looked up and the stored order does not help.
LOOKED_UP = {"songplays": ["user_id", "song_id"]}

STAGING = ["staging_events", "staging_songs"]
TARGETS = ["songplays", "users", "songs", "artists", "time"]


def numeric_type(mode: str = "exact") -> str:
    """SQL type of a bare ``numeric`` column in the given mode."""
    if mode not in NUMERIC:
        raise ValueError(f"numeric_mode must be one of {sorted(NUMERIC)}, not {mode!r}")
    return NUMERIC[mode]


def column_types(table: str, mode: str = "exact") -> list[tuple[str, str]]:
    """(name, SQL type) of each column of ``table``, in table order."""
    numeric = numeric_type(mode)
    return [(name, numeric if kind == "numeric" else kind) for name, kind in COLUMNS[table]]


def column_names(table: str) -> list[str]:
    return [name for name, _ in COLUMNS[table]]


def struct(table: str, mode: str = "exact") -> T.StructType:
    """Explicit read schema of a stored table."""
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in column_types(table, mode)))


def bloom_options(table: str) -> dict[str, str]:
    """Writer options for a Bloom filter per row group and looked-up column, of a size that
    follows the number of its values."""
    columns = LOOKED_UP.get(table, [])
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return options | {"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}

"""Literal staging rows and JSON trees for the tests."""

import json
from pathlib import Path

from playmart.schemas import struct

EVENT = {
    "artist": "Ada Brook",
    "auth": "Logged In",
    "firstName": "Vera",
    "gender": "F",
    "iteminSession": 0,
    "lastName": "Moss",
    "length": 152.92036,
    "level": "paid",
    "location": "Chicago",
    "method": "PUT",
    "page": "NextSong",
    "registration": 1541033612796.0,
    "sessionId": 41,
    "song": "Quiet Harbour",
    "status": 200,
    "ts": 1541990258796,
    "userAgent": "Mozilla",
    "userId": 15,
}
SONG = {
    "num_songs": 1,
    "artist_id": "R1",
    "artist_latitude": None,
    "artist_longitude": None,
    "artist_location": "",
    "artist_name": "Ada Brook",
    "song_id": "S1",
    "title": "Quiet Harbour",
    "duration": 152.92036,
    "year": 0,
}


def event(**changes):
    return {**EVENT, **changes}


def song(**changes):
    return {**SONG, **changes}


def _frame(spark, table, rows):
    """Typed through JSON text, like a load, but without files."""
    schema = struct(table)
    return spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows], 2))


def events(spark, *rows):
    return _frame(spark, "staging_events", rows)


def songs(spark, *rows):
    return _frame(spark, "staging_songs", rows)


def write_lines(path, lines):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + "\n" for line in lines))


def write_logs(root, name, *rows):
    """One log file below its year and month folders."""
    write_lines(Path(root) / "2018" / "11" / f"{name}-events.json", [json.dumps(r) for r in rows])


def write_song(root, track, row):
    """One song file below the folders of its three leading letters."""
    write_lines(Path(root) / track[2] / track[3] / track[4] / f"{track}.json", [json.dumps(row)])


def multiset(df):
    from collections import Counter

    return Counter(tuple(r) for r in df.collect())

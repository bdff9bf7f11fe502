"""Random staging rows against a plain Python model of every table and report."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from helpers import event, events, multiset, song, songs

from playmart.operators import duplicate_keys
from playmart.plans import reports
from playmart.plans.star import build_artists, build_songplays, build_songs, build_time, build_users

START = 1_546_214_390_000  # ten seconds before midnight on 2018-12-31


def random_rows(seed):
    rng = random.Random(seed)
    names = ["a", "b", "A", None]
    staged = [
        event(
            artist=rng.choice(names),
            song=rng.choice(["x", "y", None]),
            page=rng.choice(["NextSong"] * 4 + ["Home", "nextsong", None]),
            ts=rng.choice([START + rng.randrange(20_000), START + rng.randrange(10**9), None]),
            userId=rng.choice([1, 2, 3, None]),
            firstName=rng.choice(["f", None]),
            gender=rng.choice(["F", "M", None]),
            level=rng.choice(["free", "paid", None]),
            location=rng.choice(["", "here", None]),
        )
        for _ in range(120)
    ]
    staged += [staged[0]] * 60  # a third of the rows are copies
    catalog = [
        song(
            artist_name=rng.choice(names),
            title=rng.choice(["x", "y", "z", None]),
            song_id=rng.choice(["s1", "s2", "s3", None]),
            artist_id=rng.choice(["r1", "r2", None]),
            year=rng.choice([0, 1999, None]),
            artist_location=rng.choice(["", "there", None]),
        )
        for _ in range(25)
    ]
    return staged, catalog


def second_of(millis):
    return None if millis is None else datetime(1970, 1, 1) + timedelta(seconds=millis // 1000)


def model(staged, catalog):
    played = [e for e in staged if e["page"] == "NextSong"]
    fact = [
        (second_of(e["ts"]), e["userId"], e["level"], s["song_id"], s["artist_id"], e["sessionId"], e["location"], e["userAgent"])
        for e in played
        for s in catalog
        if e["artist"] is not None
        and e["song"] is not None
        and (e["artist"], e["song"]) == (s["artist_name"], s["title"])
    ]
    fact.sort(key=lambda row: [(value is not None, value) for value in row])
    users = {
        (e["userId"], e["firstName"], e["lastName"], e["gender"], e["level"]) for e in played if e["userId"] is not None
    }
    seconds = {second_of(e["ts"]) for e in played}
    return fact, users, seconds


@pytest.mark.parametrize("seed", range(4))
def test_tables_and_reports(spark, seed):
    staged, catalog = random_rows(seed)
    fact, users, seconds = model(staged, catalog)
    e, s = events(spark, *staged), songs(spark, *catalog)

    plays = build_songplays(e, s)
    assert Counter((n, *row) for n, row in enumerate(fact)) == multiset(plays)
    assert Counter(users) == multiset(build_users(e))
    parts = Counter(
        (t, t.hour, t.day, t.isocalendar()[1], t.month, t.year, t.isoweekday() % 7) if t else (None,) * 7 for t in seconds
    )
    assert parts == multiset(build_time(e))
    assert {tuple(r)[:4] for r in build_songs(s).collect()} == {
        (x["song_id"], x["title"], x["artist_id"], x["year"]) for x in catalog if x["song_id"]
    }
    assert {tuple(r)[:3] for r in build_artists(s).collect()} == {
        (x["artist_id"], x["artist_name"], x["artist_location"]) for x in catalog if x["artist_id"]
    }

    repeats = {k: n for k, n in Counter(u[0] for u in users).items() if n > 1}
    assert {r.user_id: r.n for r in duplicate_keys(build_users(e), "user_id").collect()} == repeats
    by_hour = Counter((h, n) for h, n in Counter(f[0].hour for f in fact if f[0]).items())
    assert multiset(reports.plays_by_hour(plays, build_time(e))) == by_hour
    assert multiset(reports.plays_by_hour_from_staging(e, s)) == by_hour
    by_level = Counter((v, n) for v, n in Counter(f[2] for f in fact).items())
    assert multiset(reports.plays_by_level(plays)) == by_level
    assert multiset(reports.plays_by_level_from_staging(e, s)) == by_level
    people = defaultdict(set)
    for user in users:
        people[user[3]].add(user[0])
    by_gender = Counter((g, len(ids)) for g, ids in people.items())
    assert multiset(reports.users_by_gender(build_users(e))) == by_gender
    assert multiset(reports.users_by_gender_from_staging(e)) == by_gender

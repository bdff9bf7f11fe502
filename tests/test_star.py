from datetime import datetime

import pytest
from helpers import event, events, multiset, song, songs

from playmart.operators import duplicate_keys
from playmart.plans import reports
from playmart.plans.star import (
    build_artists,
    build_songplays,
    build_songs,
    build_time,
    build_users,
    match_songs,
    songplay_rows,
)
from playmart.schemas import column_names


def plays(spark, event_rows, song_rows=None):
    return build_songplays(events(spark, *event_rows), songs(spark, *(song_rows or [song()])))


def test_one_play(spark):
    df = plays(spark, [event()])
    assert df.columns == column_names("songplays")
    assert [tuple(r) for r in df.collect()] == [
        (
            0,
            datetime(2018, 11, 12, 2, 37, 38),
            15,
            "paid",
            "S1",
            "R1",
            41,
            "Chicago",
            "Mozilla",
        )
    ]


@pytest.mark.parametrize("page", ["Home", None, "nextsong", "NextSong "])
def test_other_pages_reach_no_table(spark, page):
    staged = events(spark, event(page=page))
    assert plays(spark, [event(page=page)]).count() == 0
    assert build_users(staged).count() == 0
    assert build_time(staged).count() == 0


@pytest.mark.parametrize(
    "change", [{"song": "Unknown"}, {"artist": None}, {"song": None}, {"artist": "ada brook"}, {"song": "Quiet Harbour "}]
)
def test_unmatched_play_is_only_in_dimensions(spark, change):
    staged = events(spark, event(**change))
    assert plays(spark, [event(**change)]).count() == 0
    assert build_users(staged).count() == 1
    assert build_time(staged).count() == 1


def test_trailing_blanks_can_be_ignored(spark):
    staged, catalog = events(spark, event(song="Quiet Harbour  ")), songs(spark, song(artist_name="Ada Brook "))
    assert songplay_rows(staged, catalog).count() == 0
    assert songplay_rows(staged, catalog, ignore_trailing_blanks=True).count() == 1


def test_null_keys_do_not_match_each_other(spark):
    df = match_songs(events(spark, event(artist=None, song=None)), songs(spark, song(artist_name=None, title=None)))
    assert df.count() == 0


def test_duration_is_not_a_join_key(spark):
    assert plays(spark, [event(length=1.0)], [song(duration=2.0)]).count() == 1


def test_fan_out(spark):
    rows = plays(spark, [event()], [song(), song(song_id="S2")]).collect()
    assert sorted(r.songplay_id for r in rows) == [0, 1]
    assert {r.song_id for r in rows} == {"S1", "S2"}


def test_repeated_event(spark):
    staged = [event(), event()]
    assert sorted(r.songplay_id for r in plays(spark, staged).collect()) == [0, 1]
    assert build_users(events(spark, *staged)).count() == 1


def test_same_second(spark):
    staged = [event(ts=1541990258100), event(ts=1541990258400)]
    assert plays(spark, staged).count() == 2
    assert build_time(events(spark, *staged)).count() == 1


def test_level_change(spark):
    users = build_users(events(spark, event(level="free"), event(level="paid")))
    assert users.count() == 2
    assert multiset(reports.users_by_gender(users)) == {("F", 1): 1}
    assert multiset(duplicate_keys(users, "user_id")) == {(15, 2): 1}


def test_user_with_two_genders_counts_in_each(spark):
    users = build_users(events(spark, event(gender="F"), event(gender="M"), event(gender=None, userId=3)))
    assert multiset(reports.users_by_gender(users)) == {("F", 1): 1, ("M", 1): 1, (None, 1): 1}


def test_null_user_is_left_out_of_users(spark):
    assert build_users(events(spark, event(userId=None))).count() == 0
    assert plays(spark, [event(userId=None)]).count() == 1


def test_artist_variants(spark):
    df = build_artists(songs(spark, song(), song(artist_location="Paris"), song(song_id="S3")))
    assert df.count() == 2
    assert df.columns == column_names("artists")


def test_null_ids_are_left_out(spark):
    staged = songs(spark, song(song_id=None), song(artist_id=None))
    assert [r.song_id for r in build_songs(staged).collect()] == ["S1"]
    assert [r.artist_id for r in build_artists(staged).collect()] == ["R1"]


def test_unknown_year_and_empty_location_are_kept(spark):
    assert build_songs(songs(spark, song())).first().year == 0
    assert build_artists(songs(spark, song())).first().location == ""


def test_songs_do_not_need_plays(spark):
    assert build_songs(songs(spark, song(), song(song_id="S2", title="Unplayed"))).count() == 2


def test_time_row(spark):
    row = build_time(events(spark, event())).first()
    assert tuple(row) == (datetime(2018, 11, 12, 2, 37, 38), 2, 12, 46, 11, 2018, 1)


MIXED_EVENTS = [
    event(),
    event(),
    event(level=None, ts=1541993858000),
    event(level="free", userId=9, gender="M"),
    event(ts=None),
    event(artist=None),
    event(song="Unknown", ts=1542990258000),
    event(page="Home"),
    event(userId=None),
]
MIXED_SONGS = [song(), song(song_id="S2"), song(song_id=None), song(artist_name=None), song(title="Other")]


def test_staging_reports_equal_stored_reports(spark):
    staged, catalog = events(spark, *MIXED_EVENTS), songs(spark, *MIXED_SONGS)
    fact, time, users = build_songplays(staged, catalog), build_time(staged), build_users(staged)
    for stored, direct in [
        (reports.plays_by_hour(fact, time), reports.plays_by_hour_from_staging(staged, catalog)),
        (reports.plays_by_level(fact), reports.plays_by_level_from_staging(staged, catalog)),
        (reports.users_by_gender(users), reports.users_by_gender_from_staging(staged)),
    ]:
        assert stored.columns == direct.columns
        assert multiset(stored) == multiset(direct)
        assert stored.count() > 0


def test_reports_over_duplicated_time(spark):
    staged, catalog = events(spark, event(), event()), songs(spark, song())
    time = build_time(staged)
    df = reports.plays_by_hour(build_songplays(staged, catalog), time.unionAll(time))
    assert multiset(df) == {(2, 2): 1}


def test_invariants(spark):
    staged, catalog = events(spark, *MIXED_EVENTS), songs(spark, *MIXED_SONGS)
    fact = build_songplays(staged, catalog)
    seconds = {r.start_time for r in build_time(staged).collect()}
    assert {r.start_time for r in fact.collect()} <= seconds
    assert fact.count() == songplay_rows(staged, catalog).count() == 15 + 3
    assert sorted(r.songplay_id for r in fact.collect()) == list(range(18))

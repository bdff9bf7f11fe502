import json
from decimal import Decimal

import pytest
from helpers import event, song, write_lines, write_logs, write_song

from playmart.schemas import COLUMNS, column_names, struct
from playmart.sources.json_trees import (
    parse_path,
    read_events,
    read_json_quarantine,
    read_path_list,
    read_songs,
)


def test_nested_song_tree(spark, tmp_path):
    write_song(tmp_path, "TRAAB01", song())
    write_song(tmp_path, "TRABC02", song(song_id="S2", artist_latitude=-117.9))
    df = read_songs(spark, str(tmp_path))
    assert df.schema == struct("staging_songs")
    rows = {r.song_id: r for r in df.collect()}
    assert set(rows) == {"S1", "S2"}
    assert rows["S2"].artist_latitude == Decimal("-117.90000")
    plain = rows["S1"]
    assert (plain.year, plain.artist_location, plain.duration) == (0, "", Decimal("152.92036"))
    assert plain.artist_longitude is None


def test_nested_log_tree_keeps_every_page(spark, tmp_path):
    write_logs(tmp_path, "2018-11-12", event(), event(page="Home"))
    write_lines(tmp_path / "2019" / "01" / "2019-01-01-events.json", [json.dumps(event(page=None))])
    df = read_events(spark, str(tmp_path))
    assert df.columns == column_names("staging_events")
    assert sorted(str(r.page) for r in df.collect()) == ["Home", "NextSong", "None"]


@pytest.mark.parametrize(("raw", "expected"), [("39", 39), (39, 39), ("", None), (" 39 ", 39), ("  ", None), (None, None)])
def test_user_ids(spark, tmp_path, raw, expected):
    write_logs(tmp_path, "a", event(userId=raw))
    assert read_events(spark, str(tmp_path)).first().userId == expected


def test_quoted_and_bare_ids_in_one_file(spark, tmp_path):
    write_logs(tmp_path, "a", event(userId="39"), event(userId=39), event(userId=""))
    assert sorted(str(r.userId) for r in read_events(spark, str(tmp_path)).collect()) == ["39", "39", "None"]


def test_empty_text_stays_text(spark, tmp_path):
    write_logs(tmp_path, "a", event(location="", firstName=" x "))
    row = read_events(spark, str(tmp_path)).first()
    assert (row.location, row.firstName) == ("", " x ")


@pytest.mark.parametrize("change", [{"userId": "abc"}, {"ts": "soon"}, {"length": "long"}, {"status": 3_000_000_000}])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_junk_aborts(spark, tmp_path, change, ansi):
    write_logs(tmp_path, "a", event(**change))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=f"cannot load {next(iter(change))} as"):
            read_events(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize(("mode", "value"), [("exact", "1e18"), ("ddl", "1e18"), ("ddl", "1e30")])
def test_number_too_wide_aborts(spark, tmp_path, mode, value):
    write_lines(tmp_path / "2018" / "x.json", ['{"length": %s}' % value])
    with pytest.raises(Exception, match="cannot load length as decimal"):
        read_events(spark, str(tmp_path), numeric_mode=mode).collect()


@pytest.mark.parametrize(
    ("mode", "duration", "latitude"),
    [("exact", Decimal("152.92036"), Decimal("-117.90000")), ("ddl", Decimal(152), Decimal(-117))],
)
def test_numeric_modes(spark, tmp_path, mode, duration, latitude):
    write_song(tmp_path, "TRAAA", song(artist_latitude=-117.9))
    df = read_songs(spark, str(tmp_path), mode)
    assert df.schema == struct("staging_songs", mode)
    row = df.first()
    assert (row.duration, row.artist_latitude) == (duration, latitude)


@pytest.mark.parametrize("mode", ["exact", "ddl"])
def test_wide_and_float_numbers(spark, tmp_path, mode):
    write_lines(
        tmp_path / "2018" / "11" / "x.json",
        ['{"length": 12345678901234.5, "registration": 1.541033612796E12, "page": "NextSong"}'],
    )
    row = read_events(spark, str(tmp_path), numeric_mode=mode).first()
    assert row.registration == 1541033612796
    assert row.length == (Decimal("12345678901234.5") if mode == "exact" else Decimal(12345678901234))


def test_ddl_mode_does_not_round_up(spark, tmp_path):
    write_song(tmp_path, "TRAAA", song(duration=152.9999999))
    assert read_songs(spark, str(tmp_path), "ddl").first().duration == 152


def test_unknown_numeric_mode(spark, tmp_path):
    with pytest.raises(ValueError, match="numeric_mode"):
        read_songs(spark, str(tmp_path), "loose")


def test_key_match_is_case_sensitive(spark, tmp_path):
    write_logs(tmp_path, "a", {"firstname": "Vera", "page": "NextSong"})
    assert read_events(spark, str(tmp_path)).first().firstName is None


def test_broken_line_aborts(spark, tmp_path):
    write_lines(tmp_path / "2018" / "11" / "x.json", [json.dumps(event()), "{bad"])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ_FILE"):
        read_events(spark, str(tmp_path)).collect()


def test_broken_line_is_quarantined(spark, tmp_path):
    write_lines(tmp_path / "2018" / "11" / "x.json", [json.dumps(event()), "{bad"])
    good, bad = read_json_quarantine(spark, str(tmp_path), "staging_events")
    assert [r.userId for r in good.collect()] == [15]
    assert (good.count(), bad.count()) == (1, 1)
    assert good.schema == struct("staging_events")
    rows = bad.collect()
    assert [r.record for r in rows] == ["{bad"]
    assert rows[0].file.endswith("2018/11/x.json")


def test_paths_map_by_position(spark, tmp_path):
    paths = column_names("staging_events")
    paths[4] = "$['itemInSession']"
    paths[17] = "$.user.id"
    write_lines(tmp_path / "m.json", [json.dumps({"jsonpaths": paths})])
    record = {"itemInSession": 7, "user": {"id": "39", "name": "x"}, "page": "NextSong"}
    write_logs(tmp_path / "logs", "a", record)
    row = read_events(spark, str(tmp_path / "logs"), read_path_list(spark, str(tmp_path / "m.json"))).first()
    assert (row.iteminSession, row.userId, row.page) == (7, 39, "NextSong")


def test_path_count_must_match(spark, tmp_path):
    with pytest.raises(ValueError, match=f"{len(COLUMNS['staging_events'])} columns"):
        read_events(spark, str(tmp_path), ["ts"])


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("ts", ("ts", None)),
        ("$.ts", ("ts", None)),
        ("$['ts']", ("ts", None)),
        ('$["a b"]', ("a b", None)),
        ("$.user.id", ("user", "$['id']")),
        ("$['user']['ids'][0]", ("user", "$['ids'][0]")),
    ],
)
def test_parse_path(path, expected):
    assert parse_path(path) == expected


@pytest.mark.parametrize("path", ["$", "$[0]", "$x"])
def test_parse_path_rejects(path):
    with pytest.raises(ValueError):
        parse_path(path)


LOST = ['{"userId":1}{"userId":2}', '{"userId":1},{"userId":2}', '{"userId":1} xyz{bad', '[{"userId":1}]', "5", '{"userId":1', "null", "}{"]


@pytest.mark.parametrize("line", LOST)
def test_a_line_is_one_object_or_malformed(spark, tmp_path, line):
    write_lines(tmp_path / "a" / "x.json", ['{"userId":7,"firstName":"a}{b"}', "", line])
    with pytest.raises(Exception, match="MALFORMED"):
        read_events(spark, str(tmp_path)).collect()
    good, bad = read_json_quarantine(spark, str(tmp_path), "staging_events")
    assert [r.userId for r in good.collect()] == [7]
    assert [r.record for r in bad.collect()] == [line]
    assert read_json_quarantine(spark, str(tmp_path), "staging_events")[0].count() == 1

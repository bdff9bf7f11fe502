"""Incremental loads: each file once, dimensions without repeats, dense keys."""

import pytest
from helpers import event, multiset, song, write_lines, write_logs, write_song

from playmart.plans.star import build_songplays, build_time, build_users
from playmart.schemas import TARGETS
from playmart.streaming import arrivals
from playmart.streaming.arrivals import load_arrivals

DAY = 86_400_000


def ids(store):
    return sorted(r.songplay_id for r in store.table("songplays").collect())


def test_arrivals(spark, tmp_path):
    logs, catalog, root = (str(tmp_path / n) for n in ("logs", "songs", "mart"))
    write_song(catalog, "TRAAAAA", song())
    write_logs(logs, "2018-11-12", event(), event(), event(userId=9, location=None))
    store = load_arrivals(spark, logs, catalog, root)
    assert ids(store) == [0, 1, 2]
    assert store.table("users").count() == 2

    write_song(catalog, "TRAAAAB", song(song_id="S2", title="Other"))
    write_song(catalog, "TRAAAAC", song(song_id="S3", title="Third"))
    write_logs(logs, "2018-11-13", event(), event(ts=1541990258796 + DAY, song="Other", level="free"))
    store = load_arrivals(spark, logs, catalog, root)
    assert ids(store) == [0, 1, 2, 3, 4]
    assert {(r.user_id, r.level) for r in store.table("users").collect()} == {(15, "paid"), (9, "paid"), (15, "free")}
    assert store.table("time").count() == 2
    assert store.table("songs").count() == 3
    assert store.table("artists").count() == 1
    assert store.table("staging_events").count() == 5

    before = {t: multiset(store.table(t)) for t in TARGETS}
    store = load_arrivals(spark, logs, catalog, root)
    assert {t: multiset(store.table(t)) for t in TARGETS} == before


def test_one_file_per_batch_equals_one_batch(spark, tmp_path):
    logs, catalog = str(tmp_path / "logs"), str(tmp_path / "songs")
    write_song(catalog, "TRAAAAA", song())
    for day in range(3):
        write_logs(
            logs, f"2018-11-{12 + day}", *[event(ts=1541990258796 + (day + i) * DAY, userId=i, gender=None) for i in range(3)]
        )
    one = load_arrivals(spark, logs, catalog, str(tmp_path / "one"))
    many = load_arrivals(spark, logs, catalog, str(tmp_path / "many"), max_files=1)
    assert ids(one) == ids(many) == list(range(9))
    for table in ("users", "time", "songs", "artists"):
        assert multiset(one.table(table)) == multiset(many.table(table))
    assert multiset(one.table("songplays").drop("songplay_id")) == multiset(many.table("songplays").drop("songplay_id"))
    staged = many.table("staging_events")
    assert multiset(build_users(staged)) == multiset(many.table("users"))
    assert multiset(build_time(staged)) == multiset(many.table("time"))


def test_repeated_batch_replaces_its_rows(spark, tmp_path, monkeypatch):
    """A batch that fails after some of its writes is run again in full."""
    logs, catalog, root = (str(tmp_path / n) for n in ("logs", "songs", "mart"))
    write_song(catalog, "TRAAAAA", song())
    write_logs(logs, "2018-11-12", event(), event(userId=9))

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "build_songplays", fail)
        try:
            load_arrivals(spark, logs, catalog, root)
        except Exception as error:
            assert "lost" in str(error)
        else:
            raise AssertionError("the batch must fail")
    store = load_arrivals(spark, logs, catalog, root)
    assert ids(store) == [0, 1]
    assert store.table("users").count() == 2
    assert store.table("staging_events").count() == 2


def test_no_files_yet(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "songs").mkdir()
    store = load_arrivals(spark, str(tmp_path / "logs"), str(tmp_path / "songs"), str(tmp_path / "mart"))
    assert store.table("songplays").count() == 0


def plays(store):
    return multiset(store.table("songplays").drop("songplay_id"))


def test_late_songs_reach_the_fact(spark, tmp_path):
    logs, catalog, root = (str(tmp_path / n) for n in ("logs", "songs", "mart"))
    write_song(catalog, "TRAAAAA", song(title="Other"))
    write_logs(logs, "2018-11-12", event(), event(userId=9), event(song="Other"))
    assert ids(load_arrivals(spark, logs, catalog, root)) == [0]
    write_song(catalog, "TRAAAAB", song())
    assert ids(load_arrivals(spark, logs, catalog, root)) == [0, 1, 2]
    write_song(catalog, "TRAAAAC", song(song_id="S3"))  # a second song for a play that has one
    write_logs(logs, "2018-11-13", event(userId=10))
    store = load_arrivals(spark, logs, catalog, root)
    assert ids(store) == list(range(7))
    full = build_songplays(store.table("staging_events"), store.table("staging_songs"))
    assert plays(store) == multiset(full.drop("songplay_id"))


@pytest.mark.parametrize("failing", ["songs", "events"])
def test_repeated_batches_after_late_songs(spark, tmp_path, monkeypatch, failing):
    """A batch is written whole, but its commit is lost: it runs again."""
    logs, catalog, root = (str(tmp_path / n) for n in ("logs", "songs", "mart"))
    write_song(catalog, "TRAAAAA", song(title="Other"))
    write_logs(logs, "2018-11-12", event(), event(song="Other"))
    load_arrivals(spark, logs, catalog, root)
    name = f"_load_{failing}"
    load = getattr(arrivals, name)

    def lost(*args):
        load(*args)
        raise RuntimeError("lost")

    write_song(catalog, "TRAAAAB", song())
    write_logs(logs, "2018-11-13", event(userId=10))
    with monkeypatch.context() as patch:
        patch.setattr(arrivals, name, lost)
        with pytest.raises(Exception, match="lost"):
            load_arrivals(spark, logs, catalog, root)
    write_song(catalog, "TRAAAAC", song(song_id="S3"))
    store = load_arrivals(spark, logs, catalog, root)
    full = build_songplays(store.table("staging_events"), store.table("staging_songs"))
    assert plays(store) == multiset(full.drop("songplay_id"))
    assert len(set(ids(store))) == len(ids(store))


def test_a_lost_checkpoint_is_refused(spark, tmp_path):
    logs, catalog, root = (str(tmp_path / n) for n in ("logs", "songs", "mart"))
    write_song(catalog, "TRAAAAA", song())
    write_logs(logs, "2018-11-12", event())
    load_arrivals(spark, logs, catalog, root)
    (tmp_path / "mart" / "_checkpoints" / "events").rename(tmp_path / "gone")
    with pytest.raises(RuntimeError, match="checkpoint"):
        load_arrivals(spark, logs, catalog, root)


def test_malformed_lines_of_a_batch_are_set_aside(spark, tmp_path):
    logs, catalog, root = (str(tmp_path / n) for n in ("logs", "songs", "mart"))
    write_song(catalog, "TRAAAAA", song())
    write_logs(logs, "2018-11-12", event())
    write_lines(tmp_path / "logs" / "bad.json", ["{bad", '{"a":1}{"a":2}'])
    with pytest.raises(Exception, match="MALFORMED"):
        load_arrivals(spark, logs, catalog, root)
    aside = str(tmp_path / "aside")
    store = load_arrivals(spark, logs, catalog, root, quarantine=aside)
    assert ids(store) == [0]
    assert {r.record for r in spark.read.json(f"{aside}/staging_events").collect()} == {"{bad", '{"a":1}{"a":2}'}

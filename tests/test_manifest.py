"""Manifests of arriving tables: what a run reads and calls, merging, versions."""

from datetime import datetime

import pytest
from helpers import event, multiset, song, write_logs, write_song
from pyspark.sql import functions as F

from playmart import files
from playmart.schemas import struct
from playmart.sinks import Warehouse
from playmart.streaming.arrivals import ArrivalStore, key_bucket, load_arrivals
from playmart.streaming.manifest import KEPT, Entry, Manifest


def plays(spark, first, count, day=1):
    rows = [(i, datetime(2018, 11, day, i % 24), i % 5, "paid", "S", "A", 1, "Here", "agent") for i in range(first, first + count)]
    return spark.createDataFrame(rows, struct("songplays"))


def users(spark, *ids):
    return spark.createDataFrame([(i, "Ann", "Lee", "F", "paid") for i in ids], struct("users"))


def folders(tmp_path, table):
    return {p.name for p in (tmp_path / table).iterdir() if p.name.startswith("run=")}


def test_calls_do_not_grow_with_the_batches(spark, tmp_path, monkeypatch):
    store = ArrivalStore(spark, str(tmp_path), retain_seconds=0, fan_in=4)
    made = []
    real = files._hadoop
    monkeypatch.setattr(files, "_hadoop", lambda *args: made.append(args) or real(*args))
    calls = []
    for n in range(40):
        made.clear()
        assert store.next_songplay_id("events", n) == 3 * n
        store.write("songplays", plays(spark, 3 * n, 3, 1 + n % 28), "events", n)
        calls.append(len(made))
        store.merge("songplays")
    assert max(calls[KEPT + 2 :]) <= calls[KEPT + 1] + 4  # folders that a merge replaced expire with the next commit
    assert len(store.state("songplays").entries) <= 4 * 3
    assert sorted(r.songplay_id for r in store.table("songplays").collect()) == list(range(120))
    assert len(folders(tmp_path, "songplays")) == len(store.state("songplays").entries)
    manifests = [p for p in (tmp_path / "songplays" / "_manifests").iterdir() if p.suffix == ".json"]
    assert len(manifests) == KEPT


def test_merging_keeps_rows_ids_order_and_readers(spark, tmp_path):
    store = ArrivalStore(spark, str(tmp_path), fan_in=3)
    for n in range(10):
        store.write("songplays", plays(spark, 4 * n, 4, 28 - n), "events", n)
        store.write("users", users(spark, *range(5 * n, 5 * n + 5)), "events", n)
    early = {t: store.table(t) for t in ("songplays", "users")}
    before = {t: multiset(df) for t, df in early.items()}
    for table in early:
        store.merge(table)
    assert {t: multiset(df) for t, df in early.items()} == before == {t: multiset(store.table(t)) for t in early}
    entries = sorted(store.state("songplays").entries, key=lambda e: e.first)
    assert [(e.first, e.last, e.tier, e.rows) for e in entries] == [(0, 8, 2, 36), (9, 9, 0, 4)]
    merged = spark.read.parquet(f"{store.location('songplays')}/{entries[0].folder}")
    parts = merged.selectExpr("start_time", "input_file_name() AS file").groupBy("file").agg({"start_time": "max"}).collect()
    order = sorted((r.file, r[1]) for r in parts)
    assert order == sorted(order, key=lambda x: x[1])
    assert {e.folder for e in entries} < folders(tmp_path, "songplays")  # replaced folders stay for readers
    with pytest.raises(RuntimeError, match="merged"):
        store.write("songplays", plays(spark, 0, 1), "events", 4)


def test_a_batch_of_songs_reads_its_buckets(spark, tmp_path):
    logs, catalog, root = (str(tmp_path / n) for n in ("logs", "songs", "mart"))
    (tmp_path / "songs").mkdir()
    write_logs(logs, "2018-11-12", *[event(song=f"Song {i}", userId=i) for i in range(60)], event(song=None), event(page="Home"))
    store = load_arrivals(spark, logs, catalog, root, buckets=8)
    assert store.table("songplays").count() == 0 and store.table("staging_events").count() == 62
    write_song(catalog, "TRAAAAA", song(title="Song 7"))
    songs = spark.createDataFrame([(song()["artist_name"], "Song 7")], "artist_name string, title string")
    read = store.staged_plays(songs, 0)
    assert "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
    all_rows = store.table("staging_events")
    bucket = songs.select(key_bucket(songs.artist_name, songs.title, 8)).first()[0]
    expected = all_rows.filter((key_bucket(all_rows.artist, all_rows.song, 8) == bucket) & (all_rows.page == "NextSong"))
    assert multiset(read) == multiset(expected) and read.count() < 30
    store = load_arrivals(spark, logs, catalog, root)  # the number of buckets is the stored one
    assert [r.user_id for r in store.table("songplays").collect()] == [7]
    assert store.state("staging_events").buckets == 8


def test_dimensions_read_the_buckets_of_a_batch(spark, tmp_path):
    store = ArrivalStore(spark, str(tmp_path), buckets=8)
    store.write_unseen("users", users(spark, *range(100)), "events", 0)
    store.write_unseen("users", users(spark, 5, 6, 200), "events", 1)
    assert store.state("users").batch("events", 1).rows == 1
    assert store.table("users").count() == 101
    store.write_unseen("users", users(spark, 5, 6, 200), "events", 1)  # repeated
    assert store.table("users").count() == 101


def test_commits_conflict_instead_of_overwriting(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "users"))
    first = manifest.commit(manifest.read(), 0, entries=(Entry("events", 0, 0, None, 0),))
    assert manifest.read() == first
    manifest.commit(first, 0, entries=())
    with pytest.raises(Exception, match="exists"):
        manifest.commit(first, 0, entries=(Entry("events", 1, 1, None, 0),))
    assert manifest.read().entries == ()


def test_a_failed_commit_leaves_the_table(spark, tmp_path, monkeypatch):
    store = ArrivalStore(spark, str(tmp_path))
    store.write("users", users(spark, 1), "events", 0)

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(files, "write_new", fail)
        with pytest.raises(OSError, match="lost"):
            store.write("users", users(spark, 2), "events", 1)
    assert [r.user_id for r in store.table("users").collect()] == [1]


def test_readers_of_a_stored_table_survive_an_overwrite(spark, tmp_path):
    mart = Warehouse(spark, str(tmp_path), "retained")
    mart.create()
    mart.load("users", users(spark, 1))
    reader = mart.table("users")
    mart.load("users", users(spark, 2, 3))
    assert [r.user_id for r in reader.collect()] == [1]
    assert mart.table("users").count() == 2
    mart.load("users", users(spark, 4))
    assert len(list((tmp_path / "users").glob("generation-*"))) == 2
    mart.drop()
    assert not list((tmp_path / "users").glob("generation-*"))


def test_the_largest_id_comes_from_footers(spark, tmp_path):
    mart = Warehouse(spark, str(tmp_path), "footers")
    mart.create()
    assert mart.next_songplay_id() == 0
    mart.load("songplays", plays(spark, 0, 10))
    mart.load("songplays", plays(spark, 10, 7), "append")
    assert mart.next_songplay_id() == 17
    plan = mart.stored_maximum("songplays", "songplay_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(songplay_id)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    mart.drop()


def scanned(df):
    """Rows that the scan of a query gave, from its metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("kind", ["stored", "arrived"])
def test_a_point_query_skips_files_by_their_bloom_filters(spark, tmp_path, kind):
    """Each file has every fourth user, so that least and greatest values do not help."""
    mart, store = Warehouse(spark, str(tmp_path), "pruned"), ArrivalStore(spark, str(tmp_path / "arrived"))
    mart.create()
    for k in range(4):
        rows = plays(spark, 100 * k, 100).withColumn("user_id", (F.col("songplay_id") % 100 * 4 + k).cast("int")).coalesce(1)
        mart.load("songplays", rows, "append")
        store.write("songplays", rows, "events", k)
    table = {"stored": mart, "arrived": store}[kind].table("songplays")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned(table) == 400
        assert scanned(table.filter("user_id = 42")) == 100
        assert scanned(table.filter("user_id = 401")) <= 100 and table.filter("user_id = 42").count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        mart.drop()

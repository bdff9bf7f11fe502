"""Physical plans: what reaches the scan, and what must never appear."""

import re
import uuid

import pytest
from helpers import event, events, song, songs
from pyspark.sql import functions as F

from playmart.functions import calendar_parts, epoch_to_timestamp
from playmart.plans.job import load_targets
from playmart.plans.reports import plays_by_hour
from playmart.operators.lookup import ROW_BYTES, VALUE_BYTES, broadcast_within, measured_bytes
from playmart.plans.star import SONG_KEYS, build_artists, build_songplays, build_time, build_users, songplay_rows
from playmart.registry import QUERIES
from playmart.schemas import column_types
from playmart.sinks import Warehouse

SF_DIR = "/root/testdata/sf0.001"
# Queries that load first and read back; the others are one plan over the tables.
LOADING = ("arrivals", "appended", "overwritten", "ingest", "etl", "quarantined", "reset", "stored_layout", "not_null_rejects")
REPORTS = ("plays_by_hour", "plays_by_level", "users_by_gender")
VIEWS = [q for q in QUERIES if not q.startswith(LOADING) and q not in REPORTS]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    changed = {}

    def apply(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield apply
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def staged(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "mart"), f"plans_{uuid.uuid4().hex[:8]}")
    warehouse.create()
    warehouse.load("staging_events", events(spark, event(), event(page="Home")))
    warehouse.load("staging_songs", songs(spark, song()))
    yield warehouse
    spark.sql(f"DROP DATABASE {warehouse.database} CASCADE")


def read_columns(text):
    return {c.split(":")[0] for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text) for c in schema.split(",")}


@pytest.mark.parametrize("name", VIEWS)
def test_no_cross_join_and_no_python(spark, name, settings):
    settings(autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert node not in text
    if name != "songplays":  # its one broadcast is the bounded offset table
        assert "BroadcastExchange" not in text
        assert "SinglePartition" not in text


def test_page_filter_and_columns_reach_the_staging_scan(spark, staged):
    events_table, songs_table = staged.table("staging_events"), staged.table("staging_songs")
    users = plan(build_users(events_table))
    assert "EqualTo(page,NextSong)" in users and "IsNotNull(userId)" in users
    assert read_columns(users) == {"firstName", "gender", "lastName", "level", "page", "userId"}
    time = plan(build_time(events_table))
    assert "EqualTo(page,NextSong)" in time
    assert read_columns(time) == {"page", "ts"}
    rows = plan(songplay_rows(events_table, songs_table))
    for pushed in ("EqualTo(page,NextSong)", "IsNotNull(artist)", "IsNotNull(song)", "IsNotNull(artist_name)"):
        assert pushed in rows
    assert "duration" not in read_columns(rows) and "auth" not in read_columns(rows)
    assert "IsNotNull(artist_id)" in plan(build_artists(songs_table))


@pytest.mark.parametrize("name", ["nextsong_filter", "users", "time", "plays_by_hour_from_staging", "users_by_gender_from_staging"])
def test_page_filter_reaches_the_table_scan(spark, name):
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type, \[NextSong,view\]\)", plan(QUERIES[name](spark, SF_DIR)))


def test_songs_are_broadcast_by_measured_size(spark, staged, settings):
    settings(autoBroadcastJoinThreshold="-1")
    keys = staged.table("staging_songs").select(*SONG_KEYS)
    size = measured_bytes(keys)
    assert size == ROW_BYTES + sum(len(song()[c].encode()) + VALUE_BYTES for c in SONG_KEYS)
    small = plan(songplay_rows(staged.table("staging_events"), broadcast_within(keys, size)))
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small
    large = plan(songplay_rows(staged.table("staging_events"), broadcast_within(keys, size - 1)))
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_measured_bytes(spark):
    rows = [("é", 1, None), (None, None, "abc")]
    df = spark.createDataFrame(rows, "a string, b int, c string")
    assert measured_bytes(df) == 2 + 3 + 6 * VALUE_BYTES + 2 * ROW_BYTES
    assert measured_bytes(df.limit(0)) == 0


@pytest.mark.parametrize("limit", [0, 10**9])
def test_fact_is_the_same_either_way(spark, limit):
    rows = [event(userId=i % 7, ts=1541990258796 + i % 50 * 1000) for i in range(200)]
    catalog = songs(spark, song(), song(song_id="S2"), song(title="Other"))
    df = build_songplays(events(spark, *rows), catalog, broadcast_bytes=limit)
    found = df.orderBy("songplay_id").collect()
    assert [r.songplay_id for r in found] == list(range(400))
    assert {(r.user_id, r.song_id) for r in found} == {(i, s) for i in range(7) for s in ("S1", "S2")}


def test_time_shuffles_only_the_second(spark, staged):
    """The distinct moves one column; the parts are computed after it."""
    text = plan(build_time(staged.table("staging_events")))
    assert text.count("Exchange hashpartitioning(start_time") == 1
    assert "hour" not in text[text.index("Exchange hashpartitioning") :]


def test_reports_from_staging_never_join_single_rows(spark, settings):
    """Both inputs of the song join are aggregates, whatever the key skew."""
    settings(autoBroadcastJoinThreshold="-1")
    optimized = QUERIES["plays_by_hour_from_staging"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = optimized.splitlines()
    at = next(i for i, line in enumerate(lines) if "Join Inner, ((artist" in line)
    assert "Aggregate [artist" in lines[at + 1]
    assert any("Aggregate [" in line for line in lines[at + 2 :])


@pytest.fixture
def small_skew_limits(settings):
    settings(
        shuffle__partitions="32",
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="20k",
    )


def test_hot_second_is_split(spark, small_skew_limits):
    """A third of the stored plays share one second of the time dimension."""
    n = 200_000
    second = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("ts")
    plays = spark.range(0, n, 1, 16).select(F.col("id").alias("songplay_id"), (second * 1000).alias("ts"))
    plays = plays.select("songplay_id", epoch_to_timestamp("ts").alias("start_time"))
    time = spark.range(5000).select((F.col("id") * 1000).alias("ts")).select(epoch_to_timestamp("ts").alias("start_time"))
    time = time.select("start_time", *calendar_parts())
    late = sum(i % 3 != 0 and i % 5000 >= 3600 for i in range(n))
    for limit, sign in [(0, "skew=true"), (2 * 5000 * (16 + ROW_BYTES), "BroadcastHashJoin")]:
        df = plays_by_hour(plays, time.unionAll(time), broadcast_bytes=limit)
        assert {r.hour: r.song_plays for r in df.collect()} == {0: n - late, 1: late}
        assert sign in plan(df)


def test_hot_song_is_split(spark, small_skew_limits):
    """A third of the plays are of one song: its partition is read by several tasks."""
    n = 60_000
    hot = F.col("id") % 3 == 0
    key = F.when(hot, F.lit(0)).otherwise(F.col("id") % 400).cast("string")
    values = {
        "artist": key,
        "song": key,
        "userAgent": F.sha2(F.col("id").cast("string"), 256),
    }
    staged = spark.range(0, n, 1, 16).select(
        *[values.get(c, F.lit(event()[c]).cast(kind)).alias(c) for c, kind in column_types("staging_events")]
    )
    catalog = spark.range(400).select(
        F.col("id").cast("string").alias("artist_name"),
        F.col("id").cast("string").alias("title"),
        F.col("id").cast("string").alias("song_id"),
        F.lit("A").alias("artist_id"),
    )
    df = songplay_rows(staged, catalog)
    rows = df.collect()
    assert "skew=true" in plan(df)
    assert len(rows) == n
    assert sum(r.song_id == "0" for r in rows) == sum(i % 3 == 0 or i % 400 == 0 for i in range(n))


def test_dimension_files_follow_the_sort_key(spark, staged, settings):
    """Each file covers its own key range, so min/max statistics prune."""
    settings(adaptive__coalescePartitions__enabled="false")
    rows = [event(userId=i % 97, firstName=str(i)) for i in range(500)]
    load_targets(staged, events(spark, *rows), songs(spark, song()), tables=["users"])
    table = staged.table("users")
    spans = table.groupBy(F.input_file_name()).agg(F.min("user_id").alias("lo"), F.max("user_id").alias("hi")).collect()
    spans = sorted((r.lo, r.hi) for r in spans)
    assert len(spans) > 1
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_fact_order_survives_storage(spark, staged):
    load_targets(staged, events(spark, *[event(ts=1541990258796 + i * 1000) for i in range(50)]), songs(spark, song()), tables=["songplays"])
    for part in staged.table("songplays").select("start_time").rdd.glom().collect():
        assert [r.start_time for r in part] == sorted(r.start_time for r in part)

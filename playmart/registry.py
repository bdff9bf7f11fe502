"""Named queries over the parquet test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmart.functions import calendar_parts, epoch_to_timestamp
from playmart.operators import Scratch, duplicate_keys
from playmart.plans import reports, star
from playmart.plans.job import load_staging, load_targets, run_etl
from playmart.schemas import COLUMNS, NOT_NULL, SORT_KEY, TARGETS, struct
from playmart.sinks import Warehouse
from playmart.sources import json_trees
from playmart.sources.tables import staging_events, staging_songs
from playmart.streaming.arrivals import ArrivalStore, load_arrivals

Query = Callable[[SparkSession, str], DataFrame]


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_events(spark, sf_dir, plays_only=True)


def nextsong_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.play_events(_plays(spark, sf_dir)).select("userId", "sessionId", "ts", "level")


def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_events(spark, sf_dir).filter(F.col("userId").isNotNull()).select("userId", "page", "ts")


def epoch_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_events(spark, sf_dir).select("ts", epoch_to_timestamp("ts").alias("start_time"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epoch_times(spark, sf_dir).select("start_time", *calendar_parts())


def join_artist_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = star.match_songs(staging_events(spark, sf_dir), staging_songs(spark, sf_dir))
    return joined.select("artist", "song", "ts", "song_id", "artist_id")


def songplays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_songplays(_plays(spark, sf_dir), staging_songs(spark, sf_dir))


def user_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(star.build_users(_plays(spark, sf_dir)), "user_id")


def plays_by_hour_from_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.plays_by_hour_from_staging(_plays(spark, sf_dir), staging_songs(spark, sf_dir))


def plays_by_level_from_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.plays_by_level_from_staging(_plays(spark, sf_dir), staging_songs(spark, sf_dir))


def _write_logs(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """The staged events as JSON records below year and month folders."""
    path, start = scratch.path("logs"), epoch_to_timestamp("ts")
    folders = {"log_year": F.year(start), "log_month": F.month(start)}
    staging_events(spark, sf_dir).withColumns(folders).write.partitionBy(*folders).json(path)
    return path


def _write_songs(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """The staged songs as JSON records below folders of single letters."""
    path = scratch.path("songs")
    folders = {"first": F.substring("artist_name", -2, 1), "second": F.substring("artist_name", -1, 1)}
    staging_songs(spark, sf_dir).withColumns(folders).write.partitionBy(*folders).json(path)
    return path


def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_trees.read_events(spark, _write_logs(spark, sf_dir, Scratch(spark, "json")))


def ingest_songs(spark: SparkSession, sf_dir: str, numeric_mode: str = "exact") -> DataFrame:
    return json_trees.read_songs(spark, _write_songs(spark, sf_dir, Scratch(spark, "json")), numeric_mode)


def _write_lines(lines: DataFrame, scratch: Scratch) -> str:
    """One text line for each row, below an unnamed folder."""
    path = scratch.path("lines")
    lines.write.text(f"{path}/2018/all")
    return path


def ingest_dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in quotes, empty or between blanks, numbers as floats: all load."""
    line = F.format_string(
        '{"userId":"%s","sessionId":" %s ","ts":%s,"page":"%s","registration":%s.0E0}',
        F.coalesce(F.col("userId").cast("string"), F.lit("")),
        F.col("sessionId").cast("string"),
        F.col("ts").cast("string"),
        "page",
        F.col("ts").cast("string"),
    )
    path = _write_lines(staging_events(spark, sf_dir).select(line), Scratch(spark, "dirty"))
    return json_trees.read_events(spark, path).select("userId", "sessionId", "ts", "page", "registration")


def quarantined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of records that are sound, doubled on a line, followed by junk or broken off, by
    turns: the sessions of those that load, and the lines that are set aside."""
    record = F.format_string('{"sessionId":%s,"ts":%s}', F.col("sessionId").cast("string"), F.col("ts").cast("string"))
    turn = F.col("ts") % 4
    line = (
        F.when(turn == 0, record)
        .when(turn == 1, F.concat(record, record))
        .when(turn == 2, F.concat(record, F.lit(" xyz{bad")))
        .otherwise(F.expr("substring(record, 1, length(record) - 2)"))
    )
    lines = staging_events(spark, sf_dir).withColumn("record", record).select(line)
    scratch = Scratch(spark, "quarantine")
    path = _write_lines(lines, scratch)
    parsed = scratch.write("parsed", json_trees.read_json_parsed(spark, path, "staging_events"))
    scratch.drop("lines")
    good, bad = json_trees.split_malformed(parsed)
    loaded = good.select(F.col("sessionId").alias("session_id"), "ts", F.lit(None).cast("string").alias("record"))
    aside = bad.select(F.lit(None).cast("int").alias("session_id"), F.lit(None).cast("bigint").alias("ts"), "record")
    return loaded.unionAll(aside)


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database for the time of a load. Its tables' files outlive it."""
    name = f"playmart_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def _read_back(warehouse: Warehouse, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {t: warehouse.spark.read.schema(struct(t)).parquet(warehouse.location(t)) for t in tables}


def etl_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each stored table after a full load from JSON."""
    scratch = Scratch(spark, "etl")
    logs, songs = _write_logs(spark, sf_dir, scratch), _write_songs(spark, sf_dir, scratch)
    with _database(spark) as database:
        warehouse = run_etl(spark, logs, songs, scratch.path("mart"), database)
    scratch.drop("logs")
    scratch.drop("songs")
    return _counts(_read_back(warehouse, COLUMNS))


def _counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def _loaded(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A target table, read back after staging and loading from JSON."""
    scratch = Scratch(spark, "etl")
    logs, songs = _write_logs(spark, sf_dir, scratch), _write_songs(spark, sf_dir, scratch)
    with _database(spark) as database:
        warehouse = Warehouse(spark, scratch.path("mart"), database)
        warehouse.create()
        load_staging(warehouse, logs, songs)
        staged = warehouse.table("staging_events"), warehouse.table("staging_songs")
        load_targets(warehouse, *staged, tables=[table])
    scratch.drop("logs")
    scratch.drop("songs")
    return _read_back(warehouse, [table])[table]


def reset_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table after a load of all of them and a reset."""
    with _database(spark) as database:
        warehouse = Warehouse(spark, Scratch(spark, "reset").root, database)
        warehouse.create()
        warehouse.load("staging_events", staging_events(spark, sf_dir))
        warehouse.load("staging_songs", staging_songs(spark, sf_dir))
        load_targets(warehouse, warehouse.table("staging_events"), warehouse.table("staging_songs"))
        warehouse.reset()
        counts = _counts({t: warehouse.table(t) for t in COLUMNS}).collect()
    return spark.createDataFrame(counts, "table_name string, n bigint")


def not_null_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every not-null column: whether a load of the table without it failed."""
    plays, songs = _plays(spark, sf_dir), staging_songs(spark, sf_dir)
    tables = {
        "songplays": star.songplay_rows(plays, songs).withColumn("songplay_id", F.lit(0).cast("bigint")),
        "users": star.build_users(plays),
        "songs": star.build_songs(songs),
        "artists": star.build_artists(songs),
        "time": star.build_time(plays),
    }
    results = []
    with _database(spark) as database:
        warehouse = Warehouse(spark, Scratch(spark, "rejects").root, database)
        warehouse.create()
        for table, columns in NOT_NULL.items():
            for column in columns:
                emptied = tables[table].withColumn(column, F.lit(None).cast(tables[table].schema[column].dataType))
                try:
                    warehouse.load(table, emptied)
                except PySparkException as error:
                    results.append((table, column, f"NOT NULL violated: {table}.{column}" in str(error)))
                else:
                    results.append((table, column, False))
    return spark.createDataFrame(results, "table_name string, column_name string, rejected boolean")


def stored_tables(
    spark: SparkSession, sf_dir: str, tables: list[str], loads: int = 1, again: str = "append"
) -> dict[str, DataFrame]:
    """The given target tables, written ``loads`` times and read back."""
    with _database(spark) as database:
        warehouse = Warehouse(spark, Scratch(spark, "stored").root, database)
        warehouse.create()
        for n in range(loads):
            mode = again if n else "overwrite"
            load_targets(warehouse, _plays(spark, sf_dir), staging_songs(spark, sf_dir), mode, tables)
    return _read_back(warehouse, tables)


def plays_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.plays_by_hour(**stored_tables(spark, sf_dir, ["songplays", "time"]))


def plays_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.plays_by_level(**stored_tables(spark, sf_dir, ["songplays"]))


def users_by_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.users_by_gender(**stored_tables(spark, sf_dir, ["users"]))


def stored_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each stored target table the number of its files whose range of the sort key
    reaches into that of a file before it: none, so that a key's rows lie side by side. The
    files are put in order in one task, a row each."""
    counts = []
    for name, rows in stored_tables(spark, sf_dir, TARGETS).items():
        key = SORT_KEY[name]
        ranges = rows.groupBy(F.input_file_name().alias("file")).agg(F.min(key).alias("least"), F.max(key).alias("most"))
        before = F.max("most").over(Window.orderBy("least", "most").rowsBetween(Window.unboundedPreceding, -1))
        reaching = ranges.select((F.col("least") < before).alias("reaching")).agg(F.count_if("reaching").alias("n"))
        counts.append(reaching.select(F.lit(name).alias("table_name"), F.col("n").alias("overlapping_files")))
    return reduce(DataFrame.unionAll, counts)


def appended_songplays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_tables(spark, sf_dir, ["songplays"], loads=2)["songplays"]


def overwritten_songplays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_tables(spark, sf_dir, ["songplays"], loads=2, again="overwrite")["songplays"]


def arrivals_late_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without ids, where half of the songs arrive a run after the events."""
    scratch = Scratch(spark, "late")
    logs, songs, root = (scratch.path(name) for name in ("logs", "songs", "mart"))
    staging_events(spark, sf_dir).write.json(f"{logs}/all")
    catalogue = staging_songs(spark, sf_dir)
    for number, half in [(0, "early"), (1, "late")]:
        catalogue.filter(F.substring("song_id", 3, 20).cast("bigint") % 2 == number).write.json(f"{songs}/{half}")
        store = load_arrivals(spark, logs, songs, root)
    return store.table("songplays").drop("songplay_id")


def _arrivals(spark: SparkSession, sf_dir: str) -> ArrivalStore:
    """Logs arriving in two halves of the covered time, each loaded on arrival."""
    scratch = Scratch(spark, "arrivals")
    logs, songs, root = (scratch.path(name) for name in ("logs", "songs", "mart"))
    staging_songs(spark, sf_dir).write.json(f"{songs}/all")
    events = staging_events(spark, sf_dir)
    second = F.expr("ts div 1000")
    bounds = events.agg(F.min(second).alias("first"), F.max(second).alias("last")).first()
    middle = 0 if bounds["first"] is None else (bounds["first"] + bounds["last"]) // 2
    for half, arrived in [("early", second < middle), ("late", second >= middle)]:
        events.filter(arrived).write.json(f"{logs}/{half}")
        store = load_arrivals(spark, logs, songs, root)
    return store


QUERIES: dict[str, Query] = {
    "staging_events": staging_events,
    "staging_songs": staging_songs,
    "ingest_events": ingest_events,
    "ingest_songs": ingest_songs,
    "ingest_songs_ddl": lambda spark, sf_dir: ingest_songs(spark, sf_dir, "ddl"),
    "etl_row_counts": etl_row_counts,
    "nextsong_filter": nextsong_filter,
    "not_null_filter": not_null_filter,
    "epoch_to_timestamp": epoch_times,
    "calendar_parts": calendar,
    "join_artist_title": join_artist_title,
    "songplays": songplays,
    "users": lambda spark, sf_dir: star.build_users(_plays(spark, sf_dir)),
    "songs": lambda spark, sf_dir: star.build_songs(staging_songs(spark, sf_dir)),
    "artists": lambda spark, sf_dir: star.build_artists(staging_songs(spark, sf_dir)),
    "time": lambda spark, sf_dir: star.build_time(_plays(spark, sf_dir)),
    "duplicate_keys": user_duplicates,
    "appended_songplays": appended_songplays,
    "arrivals_songplays": lambda spark, sf_dir: _arrivals(spark, sf_dir).table("songplays"),
    "arrivals_users": lambda spark, sf_dir: _arrivals(spark, sf_dir).table("users"),
    "arrivals_time": lambda spark, sf_dir: _arrivals(spark, sf_dir).table("time"),
    "arrivals_late_songs": arrivals_late_songs,
    "plays_by_hour": plays_by_hour,
    "plays_by_level": plays_by_level,
    "users_by_gender": users_by_gender,
    "plays_by_hour_from_staging": plays_by_hour_from_staging,
    "plays_by_level_from_staging": plays_by_level_from_staging,
    "users_by_gender_from_staging": lambda spark, sf_dir: reports.users_by_gender_from_staging(_plays(spark, sf_dir)),
    "overwritten_songplays": overwritten_songplays,
    "reset_row_counts": reset_row_counts,
    "not_null_rejects": not_null_rejects,
    "ingest_dirty_events": ingest_dirty_events,
    "quarantined_events": quarantined_events,
    "etl_songplays": lambda spark, sf_dir: _loaded(spark, sf_dir, "songplays"),
    "etl_songs": lambda spark, sf_dir: _loaded(spark, sf_dir, "songs"),
    "etl_artists": lambda spark, sf_dir: _loaded(spark, sf_dir, "artists"),
    "stored_layout": stored_layout,
    "etl_users": lambda spark, sf_dir: _loaded(spark, sf_dir, "users"),
    "etl_time": lambda spark, sf_dir: _loaded(spark, sf_dir, "time"),
}

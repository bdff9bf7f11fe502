"""The full load: raw trees to staging tables to the star schema."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from playmart.operators import Scratch
from playmart.operators.numbering import file_by_file
from playmart.plans.star import build_artists, build_songplays, build_songs, build_time, build_users
from playmart.schemas import TARGETS
from playmart.sinks import Warehouse
from playmart.sources.json_trees import read_json_parsed, read_json_table, split_malformed


@contextmanager
def _scratch(spark: SparkSession, label: str) -> Iterator[Scratch]:
    scratch = Scratch(spark, label)
    try:
        yield scratch
    finally:
        scratch.clean()


@contextmanager
def _first_id(warehouse: Warehouse, mode: str) -> Iterator[int | Callable[[int], int]]:
    """Where a load's keys start: at 0, or with a range of its own, which a failed load gives back."""
    if mode != "append":
        yield 0
        return
    ids, taken = warehouse.songplay_ids(), []

    def reserve(rows: int) -> int:
        taken.append((ids.reserve(rows), rows))
        return taken[-1][0]

    try:
        yield reserve
    except BaseException:
        for first, rows in taken:
            ids.give_back(first, rows)
        raise


def load_staging(
    warehouse: Warehouse,
    log_path: str,
    song_path: str,
    event_paths: list[str] | None = None,
    mode: str = "overwrite",
    quarantine: str | None = None,
) -> None:
    """Read both raw trees and store them as the staging tables.

    A malformed record aborts the load, unless ``quarantine`` names a folder to
    write such records to. The stored parquet also replaces the many tiny song
    files for the reads that follow.
    """
    for table, path, paths in [("staging_events", log_path, event_paths), ("staging_songs", song_path, None)]:
        source = (warehouse.spark, path, table, paths, warehouse.numeric_mode)
        if quarantine is None:
            warehouse.load(table, read_json_table(*source), mode)
            continue
        with _scratch(warehouse.spark, table) as scratch:  # so that the files are parsed once
            rows, malformed = split_malformed(scratch.write("parsed", read_json_parsed(*source)))
            malformed.write.mode(mode).json(f"{quarantine}/{table}")
            warehouse.load(table, rows, mode)


def load_targets(
    warehouse: Warehouse,
    events: DataFrame,
    songs: DataFrame,
    mode: str = "overwrite",
    tables: list[str] = TARGETS,
    ignore_trailing_blanks: bool = False,
) -> None:
    """Build the fact and dimensions from staging and store them.

    Each table commits by itself, as there is no transaction across tables: a
    load that fails leaves the tables before it written, the others unchanged.
    """
    builders = {
        "users": lambda: build_users(events),
        "songs": lambda: build_songs(songs),
        "artists": lambda: build_artists(songs),
        "time": lambda: build_time(events),
    }
    for table in tables:
        if table == "songplays":
            with _scratch(warehouse.spark, "songplays") as scratch, _first_id(warehouse, mode) as start:
                plays = build_songplays(
                    events, songs, scratch, start, ignore_trailing_blanks=ignore_trailing_blanks
                )
                # The numbered rows are read back sorted; so they are stored.
                with file_by_file(warehouse.spark):
                    warehouse.load(table, plays, mode)
        else:
            warehouse.load(table, builders[table](), mode)


def run_etl(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    root: str,
    database: str = "playmart",
    event_paths: list[str] | None = None,
    numeric_mode: str = "exact",
    write_mode: str = "overwrite",
    staging_mode: str = "overwrite",
    ignore_trailing_blanks: bool = False,
    quarantine: str | None = None,
) -> Warehouse:
    """Load staging, then every target table.

    With the default modes a re-run gives identical tables. ``write_mode`` set to
    "append" adds this load's rows again under new keys; ``staging_mode`` set to
    "append" also stages the input again, so that each later load sees all that
    was ever staged.
    """
    warehouse = Warehouse(spark, root, database, numeric_mode)
    warehouse.create()
    load_staging(warehouse, log_path, song_path, event_paths, staging_mode, quarantine)
    load_targets(
        warehouse,
        warehouse.table("staging_events"),
        warehouse.table("staging_songs"),
        write_mode,
        ignore_trailing_blanks=ignore_trailing_blanks,
    )
    return warehouse

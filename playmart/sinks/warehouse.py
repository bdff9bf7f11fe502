"""The stored tables: definition, reset, loading and layout."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart import files
from playmart.functions.guards import enforce_not_null
from playmart.operators import duplicate_keys
from playmart.schemas import (
    COLUMNS,
    NOT_NULL,
    PRIMARY_KEY,
    SORT_KEY,
    STAGING,
    bloom_options,
    column_names,
    column_types,
    numeric_type,
)
from playmart.sinks.key_ranges import KeyRanges

WRITE_MODES = ("overwrite", "append")
GENERATION = "generation-"
LOADING = "_loading-"
COMMITTED = "_SUCCESS"


def lay_out(table: str, rows: DataFrame) -> DataFrame:
    """Order rows by the table's sort key, so that min/max statistics prune.

    Staging is always scanned whole and gains nothing from an order. The fact arrives
    sorted by its numbering, a range of it in each task. Dimensions are
    range-partitioned on all columns, sort key first, which lets one frequent key
    span several files.
    """
    if table in STAGING or table == "songplays":
        return rows
    key = SORT_KEY[table]
    rest = [c for c in rows.columns if c != key]
    return rows.repartitionByRange(key, *rest).sortWithinPartitions(key)


class Warehouse:
    """Parquet tables under ``root``, registered in the catalog as ``database``.

    A table's home is a folder below ``root`` that holds its generations. The newest
    committed one is the table; overwriting writes the next one and then moves the
    table to it, so that readers see the old rows or the new ones. The generation that
    was replaced stays until the next overwrite, for the queries that still read it. A
    session with a fresh catalog sees the stored rows again after :meth:`create`.
    """

    def __init__(self, spark: SparkSession, root: str, database: str = "playmart", numeric_mode: str = "exact"):
        numeric_type(numeric_mode)
        self.spark = spark
        self.root = files.qualified(spark, root)
        self.database = database
        self.numeric_mode = numeric_mode

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def home(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _generations(self, table: str) -> list[int]:
        """Numbers of all generation folders, committed or not."""
        names = files.names_below(self.spark, self.home(table))
        return sorted(int(n[len(GENERATION) :]) for n in names if re.fullmatch(GENERATION + r"\d+", n))

    def _folder(self, table: str, generation: int) -> str:
        return f"{self.home(table)}/{GENERATION}{generation}"

    def _committed(self, table: str) -> int:
        """The newest generation whose write has finished; 0 if there is none."""
        done = [
            g for g in self._generations(table) if COMMITTED in files.names_below(self.spark, self._folder(table, g))
        ]
        return max(done, default=0)

    def location(self, table: str) -> str:
        """The folder of the table's rows."""
        return self._folder(table, self._committed(table))

    def _registered(self, table: str) -> str | None:
        """Where the catalog has the table, or None."""
        if not self.spark.catalog.tableExists(self.name(table)):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").filter("col_name = 'Location'").collect()
        return files.qualified(self.spark, rows[-1]["data_type"]) if rows else None

    def _check_owned(self, table: str) -> str | None:
        """The registered location, which must lie in the table's home."""
        registered = self._registered(table)
        home = self.home(table)
        if registered is not None and registered != home and not registered.startswith(f"{home}/"):
            raise ValueError(f"{self.name(table)} is registered at {registered}, not below {home}: use another database")
        return registered

    def _columns(self, table: str) -> str:
        required = NOT_NULL.get(table, ())
        return ", ".join(
            f"`{name}` {kind}{' NOT NULL' if name in required else ''}"
            for name, kind in column_types(table, self.numeric_mode)
        )

    def _layout(self, table: str) -> str:
        """Columns, format and writer options of a table."""
        options = ", ".join(f"'{k}' '{v}'" for k, v in bloom_options(table).items())
        return f"({self._columns(table)}) USING parquet" + (f" OPTIONS ({options})" if options else "")

    def create(self) -> None:
        """Define every missing table; an existing one is left as it is.

        Raises if the database has a table at another root. A table whose last
        overwrite was interrupted is moved to its newest committed generation.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table in COLUMNS:
            registered, location = self._check_owned(table), self.location(table)
            if registered is None:
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} {self._layout(table)} LOCATION '{location}'")
            elif registered.startswith(f"{self.home(table)}/{GENERATION}") and registered != location:
                self._move(table, location)

    def _move(self, table: str, location: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{location}'")
        self.spark.catalog.refreshTable(self.name(table))

    def drop(self) -> None:
        """Drop every table together with its rows.

        Only generation folders are deleted: whatever else lies below the root,
        even in a folder named like a table, is not this warehouse's and stays.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table in COLUMNS:
            self._check_owned(table)
        for table in COLUMNS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            for generation in self._generations(table):
                files.delete(self.spark, self._folder(table, generation))
            for name in files.names_below(self.spark, self.home(table)):
                if re.fullmatch(LOADING + "[0-9a-f]{32}", name):  # left by an append that was killed
                    files.delete(self.spark, f"{self.home(table)}/{name}")
            files.delete_empty(self.spark, self.home(table))

    def reset(self) -> None:
        self.drop()
        self.create()

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def load(self, table: str, df: DataFrame, mode: str = "overwrite") -> None:
        """Write ``df`` into ``table``: columns by name, not-null rules enforced.

        Overwriting writes a new generation, moves the table to it and deletes those
        before the one that it replaces, a folder each. Appending writes a folder of its own
        and moves its files to the table's, so that several can append at once, but none
        while another overwrites. A load that fails or is
        interrupted before the move leaves the stored rows as they were; one interrupted
        after it leaves old folders, which the next load deletes. Raises if the database
        has the table at another root.
        """
        if mode not in WRITE_MODES:
            raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
        self._check_owned(table)
        rows = lay_out(table, enforce_not_null(df.select(*column_names(table)), table))
        if mode == "append":
            self.create()  # moves the table on if an overwrite was interrupted before
            loading = f"{self.home(table)}/{LOADING}{uuid.uuid4().hex}"
            try:
                self._write_generation(table, rows, loading)
                files.move_files(self.spark, loading, self.location(table))
            finally:
                files.delete(self.spark, loading)
        else:
            known, replaced = self._generations(table), self._committed(table)
            generation = max(known, default=0) + 1
            self._write_generation(table, rows, self._folder(table, generation))
            self._move(table, self._folder(table, generation))
            for old in known:
                if old != replaced:
                    files.delete(self.spark, self._folder(table, old))
        self.spark.catalog.refreshTable(self.name(table))

    def _write_generation(self, table: str, rows: DataFrame, folder: str) -> None:
        """Insert into a table of the same columns that lies in ``folder``."""
        loading = f"`{self.database}`.`{table}_{uuid.uuid4().hex}`"
        self.spark.sql(f"CREATE TABLE {loading} {self._layout(table)} LOCATION '{folder}'")
        try:
            rows.write.insertInto(loading)
        finally:
            self.spark.sql(f"DROP TABLE {loading}")

    def duplicate_keys(self, table: str) -> DataFrame:
        """Primary-key values stored more than once; they are legal, not removed."""
        return duplicate_keys(self.table(table), PRIMARY_KEY[table])

    def stored_maximum(self, table: str, column: str) -> DataFrame:
        """The largest value of a column, from the footers of the table's files.

        Tasks read the footers, no row is read. The settings that this takes are those of a
        session of its own.
        """
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        rows = session.read.schema(self.table(table).schema).parquet(self.location(table))
        return rows.agg(F.max(column).alias(column))

    def songplay_ids(self) -> KeyRanges:
        """The keys of the fact's present generation."""
        return KeyRanges(self.spark, f"{self.location('songplays')}/_ids", self._next_stored_id)

    def next_songplay_id(self) -> int:
        """One past the largest key that is stored or handed out to a writer."""
        return self.songplay_ids().next()

    def _next_stored_id(self) -> int:
        if all(n.startswith("_") for n in files.names_below(self.spark, self.location("songplays"))):
            return 0
        last = self.stored_maximum("songplays", "songplay_id").first()[0]
        return 0 if last is None else last + 1

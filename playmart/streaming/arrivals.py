"""Load only the files that arrived since the last run.

A file stream reads each file once. Every micro-batch is staged and then goes through the
same builders as the full load. Each batch writes folders of its own and commits them to
the manifest of their table, so a batch repeated after a failure replaces its own rows and
adds none, and readers see a table as of one commit.

A play whose song arrives later gets its fact row with the song: a batch of songs is also
joined to the plays of earlier batches of events. The manifest of the fact has up to which
batch of events that was done, so that a batch of events that is repeated later leaves
those songs out.

What a batch reads of the past does not grow with the past as such. Staged events lie in
buckets by artist and title, dimensions in buckets by their key, and a batch reads the
buckets that its rows fall into. The ids used so far are known from the manifest. Folders
of batches are merged by and by, each row as often as the number of batches has digits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart import files
from playmart.functions.guards import enforce_not_null
from playmart.operators import Scratch
from playmart.operators.numbering import file_by_file
from playmart.plans.star import build_artists, build_songplays, build_songs, build_time, build_users
from playmart.schemas import PLAY_PAGE, SORT_KEY, bloom_options, column_names, struct
from playmart.sources.json_trees import sound_rows, split_malformed, stream_json_table
from playmart.streaming.manifest import Entry, Manifest, State

BATCH = "batch_id"
BUCKET = "bucket"
RUN = "run"
SONGS, EVENTS = "songs", "events"
#: Buckets of a new store, a number that it keeps. A batch of few keys reads that share of
#: the stored rows for each of them.
BUCKETS = 16
#: Plays without an artist or a title, and events that are no plays, match no song.
NO_BUCKET = -1
BUCKETED = ("staging_events", "users", "songs", "artists")
#: Folders of one size that are merged into one.
FAN_IN = 8
#: How long a replaced folder stays for those who read it.
RETAIN_SECONDS = 3600.0


def unseen(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``rows`` that are not in ``stored``; NULLs compare equal."""
    same = [rows[c].eqNullSafe(stored[c]) for c in rows.columns]
    return rows.join(stored, same, "left_anti")


def key_bucket(artist: Column, title: Column, buckets: int) -> Column:
    """Bucket of an artist and title, which trailing blanks do not change."""
    known = artist.isNotNull() & title.isNotNull()
    return F.when(known, F.pmod(F.xxhash64(F.rtrim(artist), F.rtrim(title)), F.lit(buckets))).otherwise(NO_BUCKET)


class ArrivalStore:
    """Tables of folders that micro-batches have written, each with a manifest."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        numeric_mode: str = "exact",
        buckets: int = BUCKETS,
        retain_seconds: float = RETAIN_SECONDS,
        fan_in: int = FAN_IN,
    ):
        self.spark = spark
        self.root = files.qualified(spark, root)
        self.numeric_mode = numeric_mode
        self.buckets = buckets
        self.retain_seconds = retain_seconds
        self.fan_in = fan_in

    def location(self, table: str) -> str:
        return f"{self.root}/{table}"

    def manifest(self, table: str) -> Manifest:
        return Manifest(self.spark, self.location(table))

    def state(self, table: str) -> State:
        return self.manifest(table).read()

    def _bucket(self, table: str, buckets: int) -> Column:
        if table == "staging_events":
            bucket = key_bucket(F.col("artist"), F.col("song"), buckets)
            return F.when(F.col("page") == PLAY_PAGE, bucket).otherwise(NO_BUCKET)
        return F.pmod(F.xxhash64(SORT_KEY[table]), F.lit(buckets))

    def _write(self, table: str, rows: DataFrame, buckets: int, name: str) -> tuple[str | None, int, int | None]:
        """(folder, rows, largest id) of rows written in the table's layout."""
        seen = Observation()
        largest = F.max("songplay_id") if table == "songplays" else F.lit(None).cast("bigint")
        key = SORT_KEY[table]
        if table in BUCKETED:
            rows = rows.withColumn(BUCKET, self._bucket(table, buckets).cast("int"))
            rows = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, key)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), largest.alias("max_id"))
        write = rows.write.partitionBy(BUCKET) if table in BUCKETED else rows.write
        folder = f"{RUN}={name}-{uuid.uuid4().hex}"
        write.options(**bloom_options(table)).parquet(f"{self.location(table)}/{folder}")
        found = seen.get
        if not found["rows"]:
            files.delete(self.spark, f"{self.location(table)}/{folder}")
            return None, 0, None
        return folder, found["rows"], found["max_id"]

    def write(self, table: str, rows: DataFrame, stream: str, batch_id: int, covers: int | None = None) -> None:
        """Commit the rows of a batch, in place of those it may have committed before.

        ``covers``: the last batch of events whose plays these late rows belong to.
        """
        manifest = self.manifest(table)
        state = manifest.read()
        buckets = state.buckets or self.buckets
        checked = enforce_not_null(rows.select(*column_names(table)), table)
        if table == "time":
            checked = self._in_order(table, checked)
        checked = checked.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        written = self._write(table, checked, buckets, f"{stream}-{batch_id}")
        before = state.batch(stream, batch_id)
        if before is not None and before.first != before.last:
            raise RuntimeError(f"batch {batch_id} of {stream} is merged with others and cannot be repeated")
        entries = (*(e for e in state.entries if e is not before), Entry(stream, batch_id, batch_id, *written))
        covered = state.covered
        if covers is not None:  # a batch of events to come is not before the newest one
            covered = {s: e for s, e in covered.items() if e >= covers} | {batch_id: covers}
        manifest.commit(state, self.retain_seconds, entries=entries, buckets=buckets, covered=covered)

    def _in_order(self, table: str, rows: DataFrame) -> DataFrame:
        key = SORT_KEY[table]
        rest = [c for c in rows.columns if c not in (key, BATCH)]
        return rows.repartitionByRange(key, *rest).sortWithinPartitions(key, *rest)

    def _rows(self, table: str, entries: list[Entry], buckets: list[int] | None = None) -> DataFrame:
        """The rows of entries, with their batch; of some buckets only, if given."""
        schema = struct(table, self.numeric_mode).add(BATCH, "long")
        folders = [f"{self.location(table)}/{e.folder}" for e in entries if e.folder]
        if not folders:
            return self.spark.createDataFrame([], schema)
        if table not in BUCKETED:
            return self.spark.read.schema(schema).parquet(*folders)
        schema = schema.add(BUCKET, "integer").add(RUN, "string")
        rows = self.spark.read.schema(schema).option("basePath", self.location(table)).parquet(*folders).drop(RUN)
        return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def table(self, table: str) -> DataFrame:
        return self._rows(table, list(self.state(table).entries)).drop(BATCH)

    def next_songplay_id(self, stream: str, batch_id: int) -> int:
        """One past the largest id of all batches but the given one; no row is read."""
        state = self.state("songplays")
        own = state.batch(stream, batch_id)
        return max((e.max_id for e in state.entries if e is not own and e.max_id is not None), default=-1) + 1

    def read_batch(self, table: str, stream: str, batch_id: int) -> DataFrame:
        return self._rows(table, [self.state(table).batch(stream, batch_id)]).drop(BATCH)

    def write_unseen(self, table: str, rows: DataFrame, stream: str, batch_id: int) -> None:
        """Append the rows of a distinct dimension that other batches lack.

        Read are the stored rows of the buckets that the rows fall into. Only seconds
        between the batch's first and last one can repeat in ``time``, and the stored rows
        are in their order, so the others are not read.
        """
        state = self.state(table)
        others = [e for e in state.entries if e.folder and (e.stream, e.last) != (stream, batch_id)]
        if not others:
            return self.write(table, rows, stream, batch_id)
        scratch = Scratch(self.spark, "unseen")
        try:
            rows = scratch.write("rows", rows)
            if table == "time":
                stored = self._rows(table, others).drop(BATCH)
                first, last = rows.agg(F.min("start_time"), F.max("start_time")).first()
                if first is not None:
                    stored = stored.filter(F.col("start_time").between(F.lit(first), F.lit(last)))
            else:
                buckets = self._touched(rows.select(self._bucket(table, state.buckets).alias(BUCKET)))
                stored = self._rows(table, others, buckets).drop(BATCH)
            self.write(table, unseen(rows, stored), stream, batch_id)
        finally:
            scratch.clean()

    @staticmethod
    def _touched(rows: DataFrame) -> list[int]:
        """The different buckets of rows, at most as many as the store has."""
        return [r[0] for r in rows.distinct().collect()]

    def write_songplays(self, events: DataFrame, songs: DataFrame, stream: str, batch_id: int, blanks: bool, covers: int | None = None) -> None:
        scratch = Scratch(self.spark, "arrivals")
        try:
            start = self.next_songplay_id(stream, batch_id)
            plays = build_songplays(events, songs, scratch, start, ignore_trailing_blanks=blanks)
            with file_by_file(self.spark):
                self.write("songplays", plays, stream, batch_id, covers)
        finally:
            scratch.clean()

    def staged_plays(self, songs: DataFrame, until: int) -> DataFrame:
        """Staged events of the batches up to ``until`` that some of the songs may match."""
        state = self.state("staging_events")
        entries = [e for e in state.entries if e.last <= until]
        buckets = self._touched(songs.select(key_bucket(F.col("artist_name"), F.col("title"), state.buckets).alias(BUCKET)))
        return self._rows("staging_events", entries, [b for b in buckets if b != NO_BUCKET]).drop(BATCH)

    def uncovered_songs(self, batch_id: int) -> DataFrame:
        """Staged songs but those already joined to this batch of events."""
        staged = self._rows("staging_songs", list(self.state("staging_songs").entries))
        done = [song for song, events in self.state("songplays").covered.items() if events >= batch_id]
        return (staged.filter(~F.col(BATCH).isin(done)) if done else staged).drop(BATCH)

    def merge(self, table: str) -> None:
        """Merge entries until no size has ``fan_in`` of them.

        The newest batch of each stream stays apart, as it may be repeated. Rows and ids
        stay as they are; a table in time order is in that order within a merged entry.
        """
        manifest = self.manifest(table)
        while True:
            state = manifest.read()
            chosen = self._mergeable(state)
            if not chosen:
                return
            rows = self._rows(table, chosen)
            if table not in BUCKETED and table != "staging_songs":
                rows = self._in_order(table, rows)
            ends = min(e.first for e in chosen), max(e.last for e in chosen)
            merged = replace(chosen[0], first=ends[0], last=ends[1], folder=None, rows=0, max_id=None, tier=chosen[0].tier + 1)
            if any(e.folder for e in chosen):
                folder, count, largest = self._write(table, rows, state.buckets, f"{merged.stream}-{ends[0]}-{ends[1]}")
                if count != sum(e.rows for e in chosen):
                    raise RuntimeError(f"merging {table} changed its number of rows")
                merged = replace(merged, folder=folder, rows=count, max_id=largest)
            entries = (*(e for e in state.entries if e not in chosen), merged)
            manifest.commit(state, self.retain_seconds, entries=entries)

    def _mergeable(self, state: State) -> list[Entry]:
        groups: dict[tuple[str, int], list[Entry]] = {}
        for e in sorted(state.entries, key=lambda e: e.first):
            if e.last < state.newest(e.stream):
                groups.setdefault((e.stream, e.tier), []).append(e)
        return next((g[: self.fan_in] for _, g in sorted(groups.items()) if len(g) >= self.fan_in), [])

    def check_streams(self) -> None:
        """Raise if batches are stored whose checkpoint is gone: a stream that starts
        over would count its batches from 0 and overwrite them one by one."""
        for stream, table in [(SONGS, "staging_songs"), (EVENTS, "staging_events")]:
            checkpoint = f"{self.root}/_checkpoints/{stream}"
            if self.state(table).entries and not files.names_below(self.spark, f"{checkpoint}/offsets"):
                raise RuntimeError(f"{self.location(table)} has rows, but their checkpoint {checkpoint} is missing")


def _stage(store: ArrivalStore, table: str, stream: str, batch: DataFrame, batch_id: int, quarantine: str | None) -> DataFrame:
    """Store the typed rows of a batch and set its malformed lines aside."""
    if quarantine is None:
        store.write(table, sound_rows(batch), stream, batch_id)
    else:
        scratch = Scratch(store.spark, "parsed")
        try:
            good, bad = split_malformed(scratch.write("parsed", batch))
            bad.write.mode("overwrite").json(f"{quarantine}/{table}/{BATCH}={batch_id}")
            store.write(table, good, stream, batch_id)
        finally:
            scratch.clean()
    return store.read_batch(table, stream, batch_id)


def _load_songs(store: ArrivalStore, batch: DataFrame, batch_id: int, quarantine: str | None, blanks: bool) -> None:
    songs = _stage(store, "staging_songs", SONGS, batch, batch_id, quarantine)
    store.write_unseen("songs", build_songs(songs), SONGS, batch_id)
    store.write_unseen("artists", build_artists(songs), SONGS, batch_id)
    until = store.state("songplays").newest(EVENTS)
    if until is not None:
        store.write_songplays(store.staged_plays(songs, until), songs, SONGS, batch_id, blanks, until)
    for table in ("staging_songs", "songs", "artists", "songplays"):
        store.merge(table)


def _load_events(store: ArrivalStore, batch: DataFrame, batch_id: int, quarantine: str | None, blanks: bool) -> None:
    events = _stage(store, "staging_events", EVENTS, batch, batch_id, quarantine)
    store.write_unseen("users", build_users(events), EVENTS, batch_id)
    store.write_unseen("time", build_time(events), EVENTS, batch_id)
    store.write_songplays(events, store.uncovered_songs(batch_id), EVENTS, batch_id, blanks)
    for table in ("staging_events", "users", "time", "songplays"):
        store.merge(table)


def _run(source: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None]) -> None:
    query = (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_arrivals(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    root: str,
    event_paths: list[str] | None = None,
    numeric_mode: str = "exact",
    max_files: int | None = None,
    ignore_trailing_blanks: bool = False,
    quarantine: str | None = None,
    **layout: float,
) -> ArrivalStore:
    """Load every file not loaded before, then stop. Songs go first.

    After each run the fact holds the plays and songs of all runs, as a full load of
    all files would, but for the order of its ids: they rise with arrival. Malformed
    lines abort the batch, or are set aside in the folder ``quarantine``. ``layout`` goes
    to the :class:`ArrivalStore`.
    """
    store = ArrivalStore(spark, root, numeric_mode, **layout)
    store.check_streams()
    rest = (quarantine, ignore_trailing_blanks)
    songs = stream_json_table(spark, song_path, "staging_songs", None, numeric_mode, max_files)
    _run(songs, f"{store.root}/_checkpoints/{SONGS}", lambda df, n: _load_songs(store, df, n, *rest))
    events = stream_json_table(spark, log_path, "staging_events", event_paths, numeric_mode, max_files)
    _run(events, f"{store.root}/_checkpoints/{EVENTS}", lambda df, n: _load_events(store, df, n, *rest))
    return store

"""The committed folders of a table: one manifest, written anew with every commit.

A manifest names everything that a table consists of, so a reader needs one listing and
one small file, however many batches there were, and sees the table as of one commit.
Folders are written once, under names of their own, and never changed. What a commit
replaces stays in place, for readers of the manifest before it, until it has expired.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from playmart import files

#: Manifests that are kept; older ones are deleted with each commit.
KEPT = 10
SUFFIX = ".json"


@dataclass(frozen=True)
class Entry:
    """The rows of the batches ``first`` to ``last`` of a stream. No rows, no folder."""

    stream: str
    first: int
    last: int
    folder: str | None
    rows: int
    max_id: int | None = None
    tier: int = 0


@dataclass(frozen=True)
class State:
    """A table as of one version. ``covered`` maps the newest batches of songs to the last
    batch of events that they were joined to; ``expired`` has folders and when they were
    replaced, in seconds."""

    version: int = 0
    entries: tuple[Entry, ...] = ()
    buckets: int = 0
    covered: dict[int, int] = field(default_factory=dict)
    expired: tuple[tuple[str, float], ...] = ()

    def batch(self, stream: str, batch: int) -> Entry | None:
        return next((e for e in self.entries if e.stream == stream and e.first <= batch <= e.last), None)

    def newest(self, stream: str) -> int | None:
        return max((e.last for e in self.entries if e.stream == stream), default=None)


class Manifest:
    """The versions of one table's state, in a folder of their own below the table."""

    def __init__(self, spark: SparkSession, table_root: str):
        self.spark = spark
        self.root = table_root
        self.folder = f"{table_root}/_manifests"

    def _path(self, version: int) -> str:
        return f"{self.folder}/{version:012d}{SUFFIX}"

    def read(self) -> State:
        """The newest committed state: a listing and, if there is one, a small file."""
        names = [n for n in files.names_below(self.spark, self.folder) if n.endswith(SUFFIX) and n[0].isdigit()]
        if not names:
            return State()
        version = int(max(names).removesuffix(SUFFIX))
        stored = json.loads(files.read_text(self.spark, self._path(version)))
        return State(
            version,
            tuple(Entry(**e) for e in stored["entries"]),
            stored["buckets"],
            {int(k): v for k, v in stored["covered"].items()},
            tuple((f, t) for f, t in stored["expired"]),
        )

    def commit(self, state: State, retain_seconds: float, **changes) -> State:
        """Write the state's next version and delete what has expired.

        Raises if that version exists: someone else has written in between, and this
        writer's folders are no part of the table.
        """
        old = {e.folder for e in state.entries if e.folder}
        made = replace(state, version=state.version + 1, **changes)
        gone = old - {e.folder for e in made.entries}
        now = time.time()
        expired = [*state.expired, *((f, now) for f in sorted(gone))]
        due = [f for f, since in expired if since + retain_seconds <= now]
        made = replace(made, expired=tuple(x for x in expired if x[0] not in due))
        stored = {k: v for k, v in asdict(made).items() if k != "version"}
        files.write_new(self.spark, self._path(made.version), json.dumps(stored))
        for name in due:
            files.delete(self.spark, f"{self.root}/{name}")
        if made.version > KEPT:
            files.delete(self.spark, self._path(made.version - KEPT))
        return made

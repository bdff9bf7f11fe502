"""Ranges of surrogate keys for writers that append at the same time."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from playmart import files


class KeyRanges:
    """Ranges handed out one after the other, without gaps between them.

    A range is a small file in ``folder``, named by its first key and holding its
    length. A file is created only if it is absent, so of two writers that want to go on
    from the same key one gets it and the other goes on behind it. ``stored`` gives one past
    the largest key of the rows that are stored already.
    """

    def __init__(self, spark: SparkSession, folder: str, stored: Callable[[], int]):
        self.spark = spark
        self.folder = folder
        self.stored = stored

    def _path(self, first: int) -> str:
        return f"{self.folder}/{first:020d}"

    def next(self) -> int:
        """One past the last key handed out or stored."""
        while True:
            firsts = [n for n in files.names_below(self.spark, self.folder) if n.isdigit()]
            if not firsts:
                return self.stored()
            last = int(max(firsts))
            try:
                return max(last + int(files.read_text(self.spark, self._path(last))), self.stored())
            except Py4JJavaError:
                if files.exists(self.spark, self._path(last)):
                    raise  # else its writer has just given it back

    def reserve(self, count: int) -> int:
        """The first of ``count`` keys that no one else gets. No keys take no range."""
        while True:
            first = self.next()
            if count == 0:
                return first
            try:
                files.write_new(self.spark, self._path(first), str(count))
                return first
            except Py4JJavaError:
                if not files.exists(self.spark, self._path(first)):
                    raise

    def give_back(self, first: int, count: int) -> None:
        """Take back a range whose rows were not stored, so that the next writer gets it.

        Once someone has a range behind it, it stays: its keys are used by no row.
        """
        if self.next() == first + count and files.exists(self.spark, self._path(first)):
            files.delete(self.spark, self._path(first))

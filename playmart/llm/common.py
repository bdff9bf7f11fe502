"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Characters handed to one vectorised step inside a task.
CHUNK_CHARS = 1_000_000
#: Characters hashed in one step: running sums over their bytes take 8 times as much, and
#: what a worker has taken once it seldom gives back.
HASHED_CHARS = 250_000
#: Rows of one Arrow batch, at most. Spark's default of 10,000 can be GBs of whole texts.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def public_file(name: str) -> bytes:
    """A vocabulary file of the installed public tokenizers, read by the driver.

    A few MB whatever the data, so its broadcast has a fixed bound and executors
    need no copy of the file.
    """
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS, unless they are smaller already."""
    rows = int(spark.conf.get(BATCH_SETTING, "0"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, chars: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with at most ``chars`` characters of text, or one row.

    Yields each slice with its texts; a null text is given as an empty one. After the last
    one the worker's unused memory is given back, as the worker goes on to other jobs.
    """
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start = held = 0
        for end, text in enumerate(texts):
            if end > start and held + len(text) > chars:
                yield batch.slice(start, end - start), texts[start:end]
                start, held = end, 0
            held += len(text)
        if start < len(texts):
            yield batch.slice(start), texts[start:]
    give_back()


def give_back() -> None:
    """Return what this process's allocators hold unused to the system.

    Spark keeps Python workers for later tasks. Arrow's pool and the C library keep freed
    memory for them, together up to some 150 MB a worker that the next stage does not need.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim is not None:
        trim(0)


def list_array(values: np.ndarray, sizes: list[int] | np.ndarray) -> pa.Array:
    """An Arrow list column from its flattened values and the length of each list."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def fresh_name(taken: list[str], name: str) -> str:
    """``name``, or a variant of it that clashes with no column of ``taken``."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name = f"{name}_"
    return name


MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


#: Powers of one factor that a worker keeps, at most: 8 MB.
KEPT_POWERS = 1 << 20
_POWERS: dict[int, np.ndarray] = {}


def _powers(factor: int, count: int) -> np.ndarray:
    """The first powers of a factor modulo 2 ** 64; up to KEPT_POWERS of them are kept."""
    if count > KEPT_POWERS:
        kept, out = _powers(factor, KEPT_POWERS), np.empty(count, dtype=np.uint64)
        for start in range(0, count, KEPT_POWERS):
            piece = out[start : start + KEPT_POWERS]
            np.multiply(kept[: len(piece)], np.uint64(pow(factor, start, 1 << 64)), out=piece)
        return out
    if len(_POWERS.get(factor, ())) < count:
        steps = np.full(min(count + count // 4, KEPT_POWERS), factor, dtype=np.uint64)
        steps[0] = 1
        _POWERS[factor] = np.cumprod(steps, out=steps)
    return _POWERS[factor][:count]


def equal_slices(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(representatives, place): the first slice of each content, and for every slice
    the place of its content among them.

    Slices of a byte array are told apart by a polynomial hash, which running sums
    give for all slices at once, and then compared byte by byte with their
    representative. Slices that differ under one hash get representatives of their own.
    """
    size = len(raw) + 1
    sums = np.zeros(size, dtype=np.uint64)
    # Block by block: of the powers, few are held at a time.
    for start in range(0, len(raw), KEPT_POWERS):
        piece = raw[start : start + KEPT_POWERS]
        block = np.multiply(piece, _powers(MULTIPLIER, len(piece)), out=sums[start + 1 : start + 1 + len(piece)])
        block *= np.uint64(pow(MULTIPLIER, start, 1 << 64))
    np.cumsum(sums, out=sums)
    lengths = ends - starts
    hashes = sums[ends] - sums[starts]
    del sums
    unit, turns = _powers(INVERSE, min(size, KEPT_POWERS)), -(-size // KEPT_POWERS)
    hashes *= unit[starts % KEPT_POWERS]
    hashes *= np.array([pow(INVERSE, t * KEPT_POWERS, 1 << 64) for t in range(turns)], dtype=np.uint64)[starts // KEPT_POWERS]
    hashes += lengths.astype(np.uint64)
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    if (lengths == lengths[first][place]).all():
        at = np.arange(lengths.sum(), dtype=np.int32)
        at += np.repeat((starts - np.cumsum(lengths) + lengths).astype(np.int32), lengths)
        own = raw[at]
        at += np.repeat((starts[first][place] - starts).astype(np.int32), lengths)
        if np.array_equal(own, raw[at]):
            return first, place
    contents = [raw[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    places: dict[bytes, int] = {}
    place = np.array([places.setdefault(c, len(places)) for c in contents])
    return np.unique(place, return_index=True)[1], place


def gather(lists: list[bytes], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of the lists at the given places, one after another; a list is
    given as the bytes of its unsigned 32-bit integers."""
    flat = np.frombuffer(b"".join(lists), dtype="<u4")
    counts = np.array([len(x) // 4 for x in lists], dtype=np.int64)
    firsts = np.cumsum(counts) - counts
    sizes = counts[place]
    return flat[np.repeat(firsts[place] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())], sizes


def sums_between(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of the values from one cut to the next."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[cuts])

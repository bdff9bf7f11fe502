"""Dense surrogate keys over a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from math import ceil
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmart.functions import checked_cast
from playmart.operators.scratch import Scratch

SLOT = "__slot"
TIE = "__tie"
PART = "__part"
OFFSET = "__offset"
ORDINAL_BITS = 33  # layout of monotonically_increasing_id: partition, then row

TARGET_BYTES = 128 * 1024 * 1024
TARGET_ROWS = 2_000_000
SMALL_ROWS = 100_000
MAX_PARTITIONS = 50_000

_lock = Lock()
_inside: dict[str, tuple[int, str]] = {}  # by session: how many are within file_by_file, the setting before


@contextmanager
def file_by_file(spark: SparkSession) -> Iterator[None]:
    """Within it, a scan never puts two files into one task.

    Spark packs small files by size, which mixes distant ranges of a sorted table.
    With an opening cost of a whole split, each file, or each part of a large one, is
    a task of its own, so rows that are written again keep their order. The setting is the
    session's: of several threads within it the first one makes it, the last one restores it.
    """
    cost, split = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _inside.get(session, (0, spark.conf.get(cost)))
        _inside[session] = inside + 1, before
        if not inside:
            spark.conf.set(cost, spark.conf.get(split))
    try:
        yield
    finally:
        with _lock:
            inside, before = _inside.pop(session)
            if inside > 1:
                _inside[session] = inside - 1, before
            else:
                spark.conf.set(cost, before)


def range_partitions(total_bytes: int, rows: int, cores: int, most: int = MAX_PARTITIONS) -> int:
    """Range partitions for ``rows`` rows in ``total_bytes`` of parquet.

    Aims at TARGET_BYTES and TARGET_ROWS each; rows matter because repeated
    values all but vanish in parquet, yet are sorted at full width. Less data
    than that is spread over the idle cores. ``most`` bounds the offset table:
    beyond ``most`` times the target, partitions grow instead.
    """
    by_size = max(ceil(total_bytes / TARGET_BYTES), ceil(rows / TARGET_ROWS))
    by_cores = min(cores, ceil(rows / SMALL_ROWS))
    return max(1, min(most, max(by_size, by_cores)))


def dense_ids(
    df: DataFrame,
    id_name: str,
    scratch: Scratch,
    start: int | Callable[[int], int] = 0,
    id_type: str = "bigint",
    max_partitions: int = MAX_PARTITIONS,
) -> DataFrame:
    """Prepend ids ``start .. start + n - 1`` in the order of all columns.

    1. Write the rows once, with a tie-breaker fixed by that write. Range
       sampling then reads a table instead of repeating the joins before it.
    2. Range-partition and sort on all columns plus the tie-breaker. A hot value
       of any leading column, and even a hot group of identical rows, is spread
       over several partitions. Write again, with each row's partition and
       ordinal.
    3. The id is the partition's offset plus the ordinal. Offsets come from one
       count per partition: at most ``max_partitions`` rows of two numbers, so the
       running sum and the broadcast stay small. The default holds the targets up
       to 6.4 TB of parquet or 100 billion rows; give more for more.

    ``start`` may be a function that gives the first id for a number of rows. It is called
    once, as soon as the rows are written and counted.

    Identical rows may swap ids, which leaves the same table.
    """
    spark = df.sparkSession
    columns = df.columns
    raw = scratch.write(f"{id_name}-raw", df.withColumn(TIE, F.monotonically_increasing_id()))
    rows = raw.count()
    first = start(rows) if callable(start) else start
    partitions = range_partitions(
        scratch.bytes(f"{id_name}-raw"), rows, spark.sparkContext.defaultParallelism, max_partitions
    )
    ordered = (
        raw.repartitionByRange(partitions, *columns, TIE)
        .sortWithinPartitions(*columns, TIE)
        .drop(TIE)
        .withColumn(SLOT, F.monotonically_increasing_id())
    )
    numbered = scratch.write(f"{id_name}-sorted", ordered)
    scratch.drop(f"{id_name}-raw")

    part = F.shiftright(SLOT, ORDINAL_BITS).alias(PART)
    counts = numbered.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(OFFSET))
    ordinal = F.col(SLOT).bitwiseAND(F.lit((1 << ORDINAL_BITS) - 1))
    row_id = F.col(OFFSET) + ordinal + F.lit(first)
    if id_type != "bigint":
        row_id = checked_cast(row_id, id_type, label=id_name)
    return (
        numbered.withColumn(PART, part)
        .join(F.broadcast(offsets), PART)
        .select(row_id.alias(id_name), *columns)
    )

"""Load nested directories of JSON records into typed staging frames.

Every raw field is read as text and then cast, so quoted and bare numbers load
alike and a bad value fails the load rather than turning into NULL.
"""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions import coerce
from playmart.schemas import COLUMNS, column_names

CORRUPT = "_corrupt_record"
# Columns beside the typed ones: the line's file, and the line itself if malformed.
FILE, BAD = "_file", "_malformed"
_STEP = re.compile(r"\[\s*'((?:[^'\\]|\\.)*)'\s*\]|\[\s*\"((?:[^\"\\]|\\.)*)\"\s*\]|\.([^.\[\]]+)|\[(\d+)\]")


def parse_path(path: str) -> tuple[str, str | None]:
    """Split a field path into its top-level key and the JSON path below it.

    Takes plain keys (``ts``), dotted paths (``$.user.id``) and bracketed ones
    (``$['user']['id']``). The second part is None for a top-level field.
    """
    if not path.startswith("$"):
        return path, None
    steps, at = [], 1
    while at < len(path):
        match = _STEP.match(path, at)
        if match is None:
            raise ValueError(f"cannot read field path {path!r}")
        single, double, dotted, index = match.groups()
        steps.append(int(index) if index is not None else next(s for s in (single, double, dotted) if s is not None))
        at = match.end()
    if not steps or isinstance(steps[0], int):
        raise ValueError(f"field path {path!r} must start at a key")
    below = "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps[1:])
    return steps[0], f"${below}" if below else None


def read_path_list(spark: SparkSession, path: str) -> list[str]:
    """Field paths from a mapping file ``{"jsonpaths": [...]}``: one small text."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return json.loads(text)["jsonpaths"]


def _quoted(key: str) -> str:
    return "`" + key.replace("`", "``") + "`"


def _raw_field(path: str) -> Column:
    key, below = parse_path(path)
    column = F.col(_quoted(key))
    return column if below is None else F.get_json_object(column, below)


def _raw_schema(paths: list[str]) -> T.StructType:
    keys = dict.fromkeys(parse_path(p)[0] for p in paths)
    return T.StructType([T.StructField(k, T.StringType()) for k in keys])


def _lines(reader: Any, path: str) -> DataFrame:
    """All lines below ``path`` that are not blank, as value and file."""
    # Without recursive lookup a reader finds no rows, silently, in trees whose files
    # lie below unnamed sub-directories.
    found = reader.format("text").option("recursiveFileLookup", "true").load(path)
    lines = found.select("value", F.col("_metadata.file_path").alias(FILE))
    return lines.filter(F.trim("value", F.lit(" \t\r")) != "")


def _parsed(lines: DataFrame, table: str, paths: list[str], numeric_mode: str) -> DataFrame:
    """Typed columns of each line, with ``_corrupt_record``: the line if it is not
    exactly one JSON object, else NULL.

    A parser would take the first value of a line and drop what follows it, so each line
    is parsed as the items of an array, of which there must be one.
    """
    items = T.ArrayType(_raw_schema(paths))
    parsed = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), items, {"mode": "PERMISSIVE"})
    # Generated with the parsing, so that no expression below parses again.
    listed = lines.select("value", FILE, F.explode(F.array(F.struct(parsed.alias("items")))).alias("p"))
    raw = listed.select("value", FILE, F.col("p.items").alias("items"))
    item = F.get("items", F.lit(0))
    sound = F.coalesce((F.size("items") == 1) & F.ltrim("value").startswith("{") & item.isNotNull(), F.lit(False))
    flat = raw.select(item.alias("raw"), FILE, F.when(sound, None).otherwise(F.col("value")).alias(BAD))
    flat = flat.select("raw.*", FILE, BAD)
    # Fields of a malformed line are not cast: it may be set aside rather than fail.
    fields = [F.when(F.col(BAD).isNull(), _raw_field(path)) for path in paths]
    typed = [
        coerce(field, name, kind, numeric_mode)
        for field, (name, kind) in zip(fields, COLUMNS[table], strict=True)
    ]
    return flat.select(*typed, FILE, BAD)


def sound_rows(parsed: DataFrame) -> DataFrame:
    """The typed rows; a malformed line fails the job."""
    message = F.concat(F.lit("MALFORMED record in "), FILE, F.lit(": "), BAD)
    sound = F.when(F.col(BAD).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return parsed.filter(sound).drop(FILE, BAD)


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed rows, malformed lines with their file) of a parsed and stored frame."""
    good = parsed.filter(F.col(BAD).isNull()).drop(FILE, BAD)
    bad = parsed.filter(F.col(BAD).isNotNull()).select(F.col(FILE).alias("file"), F.col(BAD).alias("record"))
    return good, bad


def _field_paths(table: str, paths: list[str] | None) -> list[str]:
    """Paths are matched to columns by position; by default they are the names."""
    if paths is None:
        return column_names(table)
    if len(paths) != len(COLUMNS[table]):
        raise ValueError(f"{table} has {len(COLUMNS[table])} columns, but {len(paths)} field paths were given")
    return list(paths)


def read_json_table(
    spark: SparkSession, path: str, table: str, paths: list[str] | None = None, numeric_mode: str = "exact"
) -> DataFrame:
    """Typed staging frame; a malformed record or a junk value aborts the load.

    A record is one JSON object on a line of its own. A line with two of them, or with
    anything after the first, is malformed.
    """
    return sound_rows(read_json_parsed(spark, path, table, paths, numeric_mode))


def read_json_parsed(
    spark: SparkSession, path: str, table: str, paths: list[str] | None = None, numeric_mode: str = "exact"
) -> DataFrame:
    """Typed rows and malformed lines in one frame, for :func:`split_malformed`."""
    return _parsed(_lines(spark.read, path), table, _field_paths(table, paths), numeric_mode)


def stream_json_table(
    spark: SparkSession,
    path: str,
    table: str,
    paths: list[str] | None = None,
    numeric_mode: str = "exact",
    max_files: int | None = None,
) -> DataFrame:
    """Streaming form of :func:`read_json_parsed`: each file is read once."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _parsed(_lines(reader, path), table, _field_paths(table, paths), numeric_mode)


def read_json_quarantine(
    spark: SparkSession, path: str, table: str, paths: list[str] | None = None, numeric_mode: str = "exact"
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, malformed records): broken lines are reported, not fatal.

    Each part parses the files when it is evaluated; store :func:`read_json_parsed`
    and split that to parse them once.
    """
    return split_malformed(read_json_parsed(spark, path, table, paths, numeric_mode))


def read_events(
    spark: SparkSession, path: str, paths: list[str] | None = None, numeric_mode: str = "exact"
) -> DataFrame:
    """Activity logs, mapped by the position of each field path."""
    return read_json_table(spark, path, "staging_events", paths, numeric_mode)


def read_songs(spark: SparkSession, path: str, numeric_mode: str = "exact") -> DataFrame:
    """Song metadata, mapped by name (case-sensitive)."""
    return read_json_table(spark, path, "staging_songs", None, numeric_mode)

"""Line dedup: winnowing over runs of words, and deletion of later repeated runs.

A window of ``min_words`` words, wherever it begins and ends, is marked by its least hash
of half as many words (winnowing), so that equal windows have equal marks, and only marks
that repeat are looked at again. Places with equal marks and equal words around them are
repeats of the first of them. Of those whose surroundings differ one for each kind is left,
and the windows of these are told apart one by one: a mark's first place alone would hide
runs that only later places share. The words around a mark thus take the place of an
extension of matches, word by word, both ways.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.common import (
    HASHED_CHARS,
    INVERSE,
    MULTIPLIER,
    _powers,
    bound_batches,
    documents,
    fresh_name,
    list_array,
    text_chunks,
)
from playmart.operators import Scratch

#: Words that a run must have to be deleted where it repeats.
MIN_WORDS = 50

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _rolled(hashes: np.ndarray, first: np.ndarray | slice, last: np.ndarray | slice) -> np.ndarray:
    """Polynomial hashes of the runs of hashes between two lists of places."""
    size = len(hashes) + 1
    sums = np.zeros(size, dtype=np.uint64)
    np.multiply(hashes, _powers(MULTIPLIER, size)[:-1], out=sums[1:])
    np.cumsum(sums, out=sums)
    return (sums[last] - sums[first]) * _powers(INVERSE, size)[first]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    out = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def _word_edges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes begin and end."""
    edges = np.flatnonzero(np.diff(~_WHITE[raw], prepend=False, append=False))
    return edges[::2], edges[1::2]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, cuts: where the words of each text begin, and the
    end), from running sums over the bytes of all texts."""
    raws = [t.encode("utf-8", "replace") for t in texts]
    raw = np.frombuffer(b"\n".join(raws), dtype=np.uint8)
    starts, ends = _word_edges(raw)
    # Bytes count from 1, so that zeros in front of a word tell.
    rolled = _rolled(raw + np.uint64(1), starts, ends)
    hashes = _mixed(rolled + (ends - starts).astype(np.uint64) * np.uint64(MULTIPLIER))
    firsts = np.cumsum([0, *[len(r) + 1 for r in raws]])
    return hashes, np.searchsorted(starts, firsts)


def gram_words(min_words: int) -> int:
    """Words of the grams that mark windows."""
    return max(1, min_words // 2)


def word_windows(hashes: np.ndarray, cuts: np.ndarray, min_words: int) -> tuple[np.ndarray, ...] | None:
    """(hashes of grams, the starts of the windows, the place of each window's least gram),
    from the hashes of the words of several texts; None if all are shorter than a window.
    Windows lie within a text; grams that do not are in none of them."""
    if len(hashes) < min_words:
        return None
    size = gram_words(min_words)
    count = len(hashes) - size + 1
    grams = _mixed(_rolled(hashes, slice(0, count), slice(size, None)))
    # The first of the least by their upper halves; the lower ones hold the places.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
    width, reached = min_words - size + 1, 1
    while reached < width:
        step = min(reached, width - reached)
        least = np.minimum(least[:-step], least[step:])
        reached += step
    ends = np.repeat(cuts[1:], np.diff(cuts))[: len(least)]
    starts = np.flatnonzero(np.arange(min_words, min_words + len(least)) <= ends)
    if not len(starts):
        return None
    return grams, starts, (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _texts_of(places: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, places, side="right") - 1


def word_marks(hashes: np.ndarray, cuts: np.ndarray, min_words: int) -> tuple[np.ndarray, ...] | None:
    """(row, mark, around, place, ahead) of the marks of several texts: which text it is,
    the least gram of a window, a hash of all words that windows with this gram can hold,
    where in its text the gram begins, and how many of these words lie from there on."""
    found = word_windows(hashes, cuts, min_words)
    if found is None:
        return None
    grams, _, least = found
    places = least[np.concatenate([[True], least[1:] != least[:-1]])]
    row = _texts_of(places, cuts)
    start = np.maximum(places - (min_words - gram_words(min_words)), cuts[row])
    end = np.minimum(places + min_words, cuts[row + 1])
    # How far the words reach on each side is part of what they are.
    sides = ((places - start) * (min_words + 1) + (end - places)).astype(np.uint64)
    around = _mixed(_rolled(_mixed(hashes), start, end) + sides * np.uint64(MULTIPLIER))
    return row, grams[places].view(np.int64), around.view(np.int64), places - cuts[row], end - places


def windows_of_marks(
    hashes: np.ndarray, cuts: np.ndarray, min_words: int, places: np.ndarray
) -> tuple[np.ndarray, ...] | None:
    """(row, mark, digest, start) of the windows whose least gram is at one of the places,
    which count through all texts."""
    found = word_windows(hashes, cuts, min_words)
    if found is None:
        return None
    grams, starts, least = found
    wanted = np.zeros(len(grams), dtype=bool)
    wanted[places] = True
    chosen = wanted[least]
    starts, least = starts[chosen], least[chosen]
    digest = _rolled(_mixed(hashes), starts, starts + min_words)
    row = _texts_of(starts, cuts)
    return row, grams[least].view(np.int64), digest.view(np.int64), starts - cuts[row]


def cut_runs(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the runs of words, which may overlap, and the lines it lost.

    Lines that lie in a run go with their ends. Where own words are left on a line, the
    white space between them and the run goes, and what is left on both sides of a run
    is one line. All other characters stay.
    """
    raw = text.encode("utf-8", "replace")
    begins, ends = _word_edges(np.frombuffer(raw, dtype=np.uint8))
    united: list[list[int]] = []
    for start, end in sorted(runs):
        if united and start <= united[-1][1]:
            united[-1][1] = max(united[-1][1], end)
        else:
            united.append([start, end])
    parts, at, lost = [], 0, 0
    for start, end in united:
        begin, stop = int(begins[start]), int(ends[end - 1])
        before = int(ends[start - 1]) if start else 0
        after = int(begins[end]) if end < len(begins) else len(raw)
        opens = raw.rfind(b"\n", before, begin) + 1
        closes = raw.find(b"\n", stop, after)
        line_starts, line_ends = start == 0 or opens > 0, end == len(begins) or closes >= 0
        closes = closes if closes >= 0 else len(raw)
        if line_starts and line_ends:
            begin, stop = (opens, closes + 1) if closes < len(raw) else (max(opens - 1, 0), closes)
        elif line_starts:
            begin, stop = opens, after
        elif line_ends:
            begin, stop = before, closes
        else:
            stop = after
        parts.append(raw[at:begin])
        lost += raw.count(b"\n", begin, stop)
        at = stop
    left = b"".join([*parts, raw[at:]])
    return left.decode("utf-8"), lost + (1 if raw and not left else 0)


def _mark_rows(docs: DataFrame, own: list[str], text: str, min_words: int) -> DataFrame:
    """One row per mark: the columns of ``own`` and what word_marks() gives."""
    schema = T.StructType([docs.schema[c] for c in own])
    schema = schema.add("mark", T.LongType()).add("around", T.LongType())
    for name in ("place", "ahead"):
        schema = schema.add(name, T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, text, HASHED_CHARS):
            found = word_marks(*word_hashes(texts), min_words)
            if found is not None:
                yield _joined(batch, own, found, schema)

    return docs.select(*own, text).mapInArrow(run, schema)


def _window_rows(docs: DataFrame, own: list[str], text: str, places: str, min_words: int) -> DataFrame:
    """One row per window of the marks at ``places``: mark, digest and start."""
    schema = T.StructType([docs.schema[c] for c in own])
    schema = schema.add("mark", T.LongType()).add("digest", T.LongType()).add("start", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, text, HASHED_CHARS):
            hashes, cuts = word_hashes(texts)
            flat, sizes = _lists(batch.column(places))
            found = windows_of_marks(hashes, cuts, min_words, flat.to_numpy() + np.repeat(cuts[:-1], sizes))
            if found is not None:
                yield _joined(batch, own, found, schema)

    return docs.select(*own, text, places).mapInArrow(run, schema)


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All values of a list column, and how many of them each row has."""
    return column.flatten(), pc.fill_null(column.value_lengths(), 0).to_numpy()


def _joined(batch: pa.RecordBatch, own: list[str], found: tuple[np.ndarray, ...], schema: T.StructType) -> pa.RecordBatch:
    rows, values = pa.array(found[0]), found[1:]
    keys = [batch.column(c).take(rows) for c in own]
    kinds = [np.int64 if f.dataType == T.LongType() else np.int32 for f in schema.fields[len(own) :]]
    columns = [pa.array(v.astype(k, copy=False)) for v, k in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*keys, *columns], schema.names)


def repeated_passages(docs: DataFrame, scratch: Scratch, text: str, own: list[str], min_words: int) -> DataFrame:
    """Runs of words to delete, which may overlap: the columns of ``own``, start, end.

    A word is in one of them if and only if it is in a window that occurred before. No
    places are paired with each other: each is joined with the first one of its kind.
    """
    bound_batches(docs.sparkSession)
    marks = scratch.write("marks", _mark_rows(docs, own, text, min_words))
    several = marks.groupBy("mark").agg(
        F.count(F.lit(1)).alias("n"), (F.min("around") < F.max("around")).alias("differ")
    )
    # Written, so that adaptive execution can split a frequent mark's rows in the join.
    several = scratch.write("several", several.filter("n > 1").drop("n"))
    # The sides that hold a key once are hashed, which spares sorting the other one.
    marks = scratch.write("repeated", marks.join(several.hint("shuffle_hash"), "mark"))
    spot = F.struct(*own, "place")
    kinds = marks.groupBy("mark", "around", "differ").agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("first"))
    kinds = scratch.write("kinds", kinds.filter("n > 1 or differ"))
    firsts = kinds.filter("n > 1").select("mark", "around", "first")
    equal = marks.join(firsts.hint("shuffle_hash"), ["mark", "around"]).filter(~spot.eqNullSafe(F.col("first")))
    start = F.greatest(F.col("place") - (min_words - gram_words(min_words)), F.lit(0))
    equal = equal.select(*own, start.alias("start"), (F.col("place") + F.col("ahead")).alias("end"))

    chosen = kinds.filter("differ").groupBy(*(F.col(f"first.{c}").alias(c) for c in own))
    chosen = chosen.agg(F.collect_list("first.place").alias("places"))
    chosen = chosen.select(*(F.col(c).alias(f"at_{c}") for c in own), "places")
    same = F.lit(True)
    for c in own:
        same = same & docs[c].eqNullSafe(chosen[f"at_{c}"])
    windows = scratch.write("windows", _window_rows(docs.join(chosen.hint("shuffle_hash"), same), own, text, "places", min_words))
    spot = F.struct(*own, "start")
    first = windows.groupBy("mark", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("first"))
    first = scratch.write("first", first.filter("n > 1").drop("n"))
    later = windows.join(first.hint("shuffle_hash"), ["mark", "digest"]).filter(~spot.eqNullSafe(F.col("first")))
    later = later.select(*own, "start", (F.col("start") + min_words).alias("end"))
    return equal.unionAll(later)


def remove_passages(
    docs: DataFrame,
    scratch: Scratch,
    text: str = "text",
    id_column: str = "doc_id",
    min_words: int = MIN_WORDS,
    name: str = "removed_lines",
) -> DataFrame:
    """Delete from each text the runs of words that occurred before; add ``name``, the
    number of ends of lines that went, and one more for a text that is empty then.

    Words are parted by white space, ends of lines too. Every word goes that is in a run
    of ``min_words`` words which starts in a document of a smaller id, or further up in
    its own, as well. A null id is less than any other, rows of one id stand by a hash of
    their text, and rows that are equal in both are one document: they stay alike. A null
    text stays null, an empty one empty; an empty table gives an empty one. Texts are read
    whole. How white space and lines are left says cut_runs(). Other columns stay; one
    called ``name`` is replaced.
    """
    docs = docs.drop(name)
    tie, runs = fresh_name(docs.columns, "text_hash"), fresh_name(docs.columns, "text_runs")
    keyed = docs.withColumn(tie, F.xxhash64(text))
    own = [fresh_name(keyed.columns, "run_id"), fresh_name(keyed.columns, "run_tie")]
    order = [F.col(id_column).alias(own[0]), F.col(tie).alias(own[1])]
    found = repeated_passages(keyed.select(*order, F.col(text).alias("run_text")), scratch, "run_text", own, min_words)
    # As a set, so that repeated rows hold no more than one of them.
    by_text = found.groupBy(*own).agg(F.collect_set(F.struct("start", "end")).alias(runs))
    same = keyed[id_column].eqNullSafe(by_text[own[0]]) & (keyed[tie] == by_text[own[1]])
    joined = keyed.join(by_text.hint("shuffle_hash"), same, "left").drop(*own, tie)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.IntegerType())])
    names, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lost, cut = np.zeros(batch.num_rows, dtype=np.int32), []
            columns = [batch.column(c) for c in names]
            marked = batch.column(runs).is_valid()
            spans, sizes = _lists(batch.column(runs))
            pairs = list(zip(*(spans.field(f).to_pylist() for f in ("start", "end")), strict=True))
            ends = np.cumsum(sizes).tolist()
            for row in np.flatnonzero(sizes).tolist():
                own_runs = pairs[ends[row] - sizes[row] : ends[row]]
                body, lost[row] = cut_runs(columns[place][row].as_py(), own_runs)
                cut.append(body)
            if cut:
                columns[place] = pc.replace_with_mask(columns[place], marked, pa.array(cut, type=columns[place].type))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lost)], schema.names)

    return joined.select(*docs.columns, runs).mapInArrow(run, schema)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later repeats of runs of 50 words or more."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    cleaned = remove_passages(docs, Scratch(spark, "lines"))
    return cleaned.select(
        "doc_id",
        F.col("removed_lines").cast("bigint").alias("removed_lines"),
        F.length("text").cast("bigint").alias("n_chars_left"),
        F.sha2("text", 256).alias("text_sha256"),
    )

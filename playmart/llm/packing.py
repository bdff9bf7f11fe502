"""Tokenisation into pieces, and best-fit packing of pieces into sequences."""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.common import (
    bound_batches,
    documents,
    fresh_name,
    gather,
    list_array,
    public_file,
    sums_between,
    text_chunks,
)
from playmart.operators import Scratch

VOCABULARY = "word_bpe_49k.json"
END_OF_DOCUMENT = 1
SEQUENCE_TOKENS = 4096
#: Words remembered by one Python worker, and the longest word worth remembering.
CACHED_WORDS, CACHED_BYTES = 1_000_000, 64
#: Words handed to the tokenizer at once: its results take far more memory than the ids.
ASKED_WORDS = 10_000
#: Characters looked up together: more of them share their words.
TOGETHER_CHARS = 3_000_000
# ASCII white space, which parts words in any case.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# What the vocabulary's word-closing tokens end with.
CLOSING = "</w>"
# ASCII punctuation, which the tokenizer never joins with a letter before it.
PUNCTUATION = string.punctuation.encode()
MARKS = np.zeros(256, dtype=bool)
MARKS[list(PUNCTUATION)] = True
#: Sequences that one group of pieces fills, about. A group is packed by one task and
#: leaves a part-filled sequence or two, so larger groups waste less.
GROUP_SEQUENCES = 1024
BIN_BITS = 24


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds: tokens, documents, and attention cost, which is the
    sum of the squared lengths of its pieces."""

    tokens: int = SEQUENCE_TOKENS
    documents: int = SEQUENCE_TOKENS
    attention: int = SEQUENCE_TOKENS**2

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def distinct_words(whole: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, place, starts) of lower-cased UTF-8 without white space: the distinct words,
    the place of each word of the text among them, and where each starts in the text.

    Punctuation at a word's end is a word by itself where it follows an ASCII letter.
    """
    raw = np.frombuffer(whole, dtype=np.uint8)
    black = ~WHITE[raw]
    inside = np.concatenate([[False], black, [False]])
    bounds = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = bounds[::2], bounds[1::2]
    # The last byte up to each one that is no punctuation ends the word's stem.
    last = np.where(MARKS[raw], np.int32(-1), np.arange(len(raw), dtype=np.int32))
    stems = np.maximum.accumulate(last, out=last)[ends - 1] + 1
    before = raw[stems - 1]
    parted = np.flatnonzero((stems > starts) & (stems < ends) & (before >= ord("a")) & (before <= ord("z")))
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    offsets = np.insert(offsets, parted + 1, offsets[parted] + (stems - starts)[parted]).astype(np.int32)
    starts = np.insert(starts, parted + 1, stems[parted])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[black])]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    _, cuts, held = coded.dictionary.buffers()
    cuts = np.frombuffer(cuts, dtype=np.int32)[: len(coded.dictionary) + 1].tolist()
    distinct = held.to_pybytes() if held is not None else b""
    return list(map(distinct.__getitem__, map(slice, cuts[:-1], cuts[1:]))), coded.indices.to_numpy(), starts


class WordIds:
    """Ids of white-space-free words, as little-endian bytes.

    The tokenizer drops white space and case and merges within words only, so a
    text's ids are those of its words in order. It also parts a letter from
    punctuation, so a word is looked up without the punctuation at its end, and that
    by itself. Each word is merged by the tokenizer when it is first seen, many at once.
    """

    def __init__(self, vocabulary: bytes, cached_words: int | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        tokens = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(tokens.values()) + 1, dtype=bool)
        self.closing[[i for t, i in tokens.items() if t.endswith(CLOSING)]] = True
        self.known: dict[bytes, bytes] = {}
        self.cached_words = CACHED_WORDS if cached_words is None else cached_words

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each). Equal words are looked up once."""
        whole = "\n".join([*texts, ""]).encode().lower()
        words, place, starts = distinct_words(whole)
        cuts = np.searchsorted(starts, np.cumsum([0, *(len(t.encode()) + 1 for t in texts)]))
        known = self.known
        found = list(map(known.get, words))
        missing = [n for n, ids in enumerate(found) if ids is None]
        new = [words[n] for n in missing]
        stems = [w.rstrip(PUNCTUATION) for w in new]
        parts = [
            (s, w[len(s) :]) if len(s) < len(w) and s.decode().lower()[-1:].isalpha() else (w,)
            for w, s in zip(new, stems, strict=True)
        ]
        asked = list({p for each in parts for p in each}.difference(known))
        self._learn(asked)
        for word, each in zip(new, parts, strict=True):
            if len(each) == 2:
                known[word] = known[each[0]] + known[each[1]]
        for n, word in zip(missing, new, strict=True):
            found[n] = known[word]
        ids, sizes = gather(found, place)
        # Frequent words come early; once the memory is full, later ones are rare.
        added = {*new, *asked}
        room = self.cached_words - len(known) + len(added)
        for number, word in enumerate(added):
            if number >= room or len(word) > CACHED_BYTES:
                del known[word]
        return ids, sums_between(sizes, cuts)

    def _learn(self, asked: list[bytes]) -> None:
        """Look up words without punctuation at their end."""
        # Lower-case ASCII letters are one word to the tokenizer as they are, so only its
        # model is asked.
        merged = self.tokenizer.model.tokenize
        letters = [a for a in asked if a.isalpha()]
        for at in range(0, len(letters), ASKED_WORDS):
            some, flat, cuts = letters[at : at + ASKED_WORDS], [], [0]
            for word in some:
                flat += [t.id for t in merged(word.decode())]
                cuts.append(4 * len(flat))
            raw = np.array(flat, dtype="<u4").tobytes()
            self.known.update(zip(some, map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:])), strict=True))
        asked = [a for a in asked if not a.isalpha()]
        decoded = [a.decode() for a in asked]
        single = [d.lower().isalpha() for d in decoded]
        # A word of letters only has one last token and that closes it, so many of
        # them can be looked up as one text.
        words = [a for a, s in zip(asked, single, strict=True) if s]
        plain = [d for d, s in zip(decoded, single, strict=True) if s]
        for at in range(0, len(words), ASKED_WORDS):
            some, text = words[at : at + ASKED_WORDS], " ".join(plain[at : at + ASKED_WORDS])
            coded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(coded.ids, dtype="<u4")
            ends = np.flatnonzero(self.closing[ids]) + 1
            raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
            if len(ends) != len(some):
                raise AssertionError("words and closing tokens differ")
            self.known.update(zip(some, map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:])), strict=True))
        others = [a for a, s in zip(asked, single, strict=True) if not s]
        for at in range(0, len(others), ASKED_WORDS):
            some = others[at : at + ASKED_WORDS]
            coded = self.tokenizer.encode_batch_fast([a.decode() for a in some], add_special_tokens=False)
            for word, c in zip(some, coded, strict=True):
                self.known[word] = np.array(c.ids, dtype="<u4").tobytes()


@cache
def _word_ids(vocabulary: bytes, cached_words: int) -> WordIds:
    """One per Python worker, kept for the tasks that follow."""
    return WordIds(vocabulary, cached_words)


def token_pieces(
    docs: DataFrame,
    vocabulary: bytes,
    max_tokens: int = SEQUENCE_TOKENS,
    text: str = "text",
    id_column: str = "doc_id",
    with_ids: bool = False,
    cached_words: int = CACHED_WORDS,
    together_chars: int = TOGETHER_CHARS,
) -> DataFrame:
    """The token ids of each document, closed by END_OF_DOCUMENT and cut into pieces
    of ``max_tokens``; only the last piece may be shorter.

    Returns id_column, piece, start, length, ids_crc32, and ``ids array<int>`` if
    ``with_ids``. A null text counts as an empty one and gives one piece of one token.
    Repeated rows give their pieces each. Other columns are ignored. ``cached_words`` and
    ``together_chars`` trade a worker's memory for time; they change no result.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField("_id", kind), T.StructField("piece", T.IntegerType())])
    for name in ("start", "length", "ids_crc32"):
        schema = schema.add(name, T.LongType())
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    end = np.array([END_OF_DOCUMENT], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(shared.value, cached_words)
        for batch, texts in text_chunks(batches, "_text", together_chars):
            rows, numbers, starts, cut = [], [], [], []
            coded, sizes = words.encode(texts)
            flat, stops = coded.tobytes(), (4 * np.cumsum(sizes)).tolist()
            for row, (begin, stop) in enumerate(zip([0, *stops], stops, strict=False)):
                ids = flat[begin:stop] + end
                for number, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(at // 4)
                    cut.append(ids[at : at + 4 * max_tokens])
            columns = [
                batch.column("_id").take(pa.array(rows, type=pa.int32())),
                pa.array(numbers, type=pa.int32()),
                pa.array(starts, type=pa.int64()),
                pa.array([len(c) // 4 for c in cut], type=pa.int64()),
                pa.array([zlib.crc32(c) for c in cut], type=pa.int64()),
            ]
            if with_ids:
                numbers = np.frombuffer(b"".join(cut), dtype="<u4").astype(np.int32)
                columns.append(list_array(numbers, [len(c) // 4 for c in cut]))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    plain = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    return plain.mapInArrow(run, schema).withColumnRenamed("_id", id_column)


def best_fit(lengths: np.ndarray, capacity: Capacity, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length. Longest first; each goes into the open bin that
    the rule prefers among those where all three capacities suffice, or a new one.

    "norm" takes the least weighted norm of what would be left in the bin; "dot" the
    largest weighted dot product of the piece with what is left. A capacity weighs
    as much as all pieces together ask of it, so that the scarcest leads. Ties go to
    the oldest bin. A single piece that exceeds a capacity raises ValueError.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule must be norm or dot, not {rule!r}")
    limits = capacity.vector()
    asked = np.stack([lengths, np.ones(len(lengths)), lengths.astype(np.float64) ** 2], axis=1) / limits
    if len(asked) and asked.max() > 1:
        raise ValueError("a piece exceeds a capacity of a sequence")
    weights = asked.sum(axis=0) ** 2
    weights /= weights.sum() or 1
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    left = np.empty((len(lengths), 3))
    used = np.zeros(len(lengths), dtype=np.int64)
    # Bins that cannot take even the least piece leave the search.
    open_bins = np.empty(0, dtype=np.int64)
    least = asked.min(axis=0) if len(asked) else None
    count = 0
    slack = 1e-9  # sums of fractions of whole numbers
    for item in np.argsort(-lengths, kind="stable"):
        need = asked[item]
        rest = left[open_bins] - need
        fits = np.flatnonzero((rest >= -slack).all(axis=1))
        if len(fits):
            score = (rest[fits] ** 2) @ weights if rule == "norm" else -(left[open_bins[fits]] * need) @ weights
            chosen = open_bins[fits[score.argmin()]]
        else:
            chosen = count
            left[chosen] = 1.0
            open_bins = np.append(open_bins, chosen)
            count += 1
        bins[item], offsets[item] = chosen, used[chosen]
        left[chosen] -= need
        used[chosen] += lengths[item]
        if (left[chosen] < least - slack).any():
            open_bins = open_bins[open_bins != chosen]
    return bins, offsets


def pack(
    pieces: DataFrame,
    scratch: Scratch,
    capacity: Capacity = Capacity(),
    length: str = "length",
    rule: str = "norm",
    group_sequences: int = GROUP_SEQUENCES,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: each piece's sequence and place in it.

    The pieces are written once with a row number and dealt at random into groups of
    about ``group_sequences`` sequences, however equal or frequent their lengths or
    ids are; one task packs one group. Nothing but the total length reaches the driver.

    Null lengths raise. Repeated rows are packed each. All columns pass through; one
    that is called sequence_id or offset is replaced. No rows give no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    number = fresh_name(pieces.columns, "packing_row")
    group = fresh_name([*pieces.columns, number], "packing_group")
    stored = scratch.write("pieces", pieces.withColumn(number, F.monotonically_increasing_id()))
    total = stored.agg(F.sum(length)).first()[0] or 0
    groups = max(1, ceil(total / (group_sequences * capacity.tokens)))
    dealt = stored.withColumn(group, F.pmod(F.xxhash64(number), F.lit(groups)))
    schema = pieces.schema.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(number)
        bins, offsets = best_fit(table.column(length).to_numpy().astype(np.int64), capacity, rule)
        own = table.column(group)[0].as_py() << BIN_BITS
        table = table.drop_columns([number, group])
        return table.append_column("sequence_id", pa.array(bins + own)).append_column("offset", pa.array(offsets))

    return dealt.groupBy(group).applyInArrow(run, schema)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(documents(spark, sf_dir))


def pack_documents(
    docs: DataFrame, cached_words: int = CACHED_WORDS, together_chars: int = TOGETHER_CHARS
) -> DataFrame:
    pieces = token_pieces(
        docs, public_file(VOCABULARY), cached_words=cached_words, together_chars=together_chars
    )
    return pack(pieces, Scratch(docs.sparkSession, "packing"))

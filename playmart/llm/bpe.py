"""Byte-level BPE: vectorised pre-tokenisation, cached merging, decoding.

Texts become arrays of code points, and code points become classes through one
table lookup. A finite automaton over those classes starts a new piece or
continues the current one. Each class is a function from state to state; the
functions compose associatively, so the state before every character follows
from a blocked prefix scan of function numbers, without a regular expression.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.common import (
    bound_batches,
    documents,
    equal_slices,
    gather,
    list_array,
    public_file,
    sums_between,
    text_chunks,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces remembered by one Python worker, and the longest piece worth remembering.
CACHED_PIECES, CACHED_BYTES = 400_000, 64
#: Rank of a pair that is no token.
NONE = 1 << 40

# The white space of the Unicode property White_Space.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# The letters after an apostrophe that make a piece with it.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ["re", "ve", "ll"]

# Classes of a code point; the first five come from the table, the others from
# what follows the code point. BREAK stands between two texts.
LETTER, NUMBER, OTHER, SPACE, BLANK, SHORT, LONG, RUN, BREAK = range(9)
# States: between pieces; in letters, numbers, others or white space; after a
# space that belongs to what follows; one or two letters before a piece's end.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_RUN, AFTER_SPACE, ONE_LEFT, TWO_LEFT = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a character of class ``kind``, and if it starts a piece."""
    if kind == BREAK:
        return FREE, True
    if kind == SPACE:
        return AFTER_SPACE, True
    if kind == BLANK:
        return FREE, True
    if kind == RUN:
        return IN_RUN, state != IN_RUN
    if kind == LETTER:
        if state in (ONE_LEFT, TWO_LEFT):
            return (FREE if state == ONE_LEFT else ONE_LEFT), False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if state in (IN_OTHERS, AFTER_SPACE):
        return IN_OTHERS, False
    return {SHORT: ONE_LEFT, LONG: TWO_LEFT}.get(kind, IN_OTHERS), True


@cache
def _class_table() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        major = unicodedata.category(chr(code))[0]
        if major == "L":
            kinds[code] = LETTER
        elif major == "N":
            kinds[code] = NUMBER
    kinds[WHITE_SPACE] = BLANK
    kinds[0x20] = SPACE
    return kinds


@cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function number of each class, composition, application, piece starts).

    The functions are those of the classes, closed under composition: a few
    dozen maps of eight states.
    """
    states, kinds = range(8), range(9)
    of_kind = [tuple(_step(s, k)[0] for s in states) for k in kinds]
    identity = tuple(states)
    numbers = {identity: 0}
    todo = [identity]
    while todo:
        first = todo.pop()
        for second in of_kind:
            both = tuple(second[first[s]] for s in states)
            if both not in numbers:
                numbers[both] = len(numbers)
                todo.append(both)
    maps = sorted(numbers, key=numbers.get)
    compose = np.zeros((len(maps), len(maps)), dtype=np.uint8)
    for (i, first), (j, second) in product(enumerate(maps), repeat=2):
        compose[i, j] = numbers[tuple(second[first[s]] for s in states)]
    starts = np.array([[_step(s, k)[1] for k in kinds] for s in states])
    return np.array([numbers[f] for f in of_kind], dtype=np.uint8), compose, np.array(maps, dtype=np.uint8), starts


def _prefix_scan(functions: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Composition of all functions up to and with each place.

    Blocks of about the square root of the length are scanned side by side, then
    the blocks' totals in the same way, and each block is put after what precedes it.
    """
    size = len(functions)
    if size <= 64:
        out = functions.copy()
        for i in range(1, size):
            out[i] = compose[out[i - 1], out[i]]
        return out
    width = max(2, int(size**0.5) // 4)
    blocks = -(-size // width)
    padded = np.zeros(blocks * width, dtype=np.uint8)  # 0 is the identity
    padded[:size] = functions
    columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
    for i in range(1, width):
        columns[i] = compose[columns[i - 1], columns[i]]
    totals = _prefix_scan(columns[-1], compose)
    before = np.concatenate([np.zeros(1, dtype=np.uint8), totals[:-1]])
    return compose[before[None, :], columns].T.reshape(-1)[:size]


def piece_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each code point starts a piece. ``ends``: the places between texts,
    which hold a zero that belongs to no text."""
    table = _class_table()
    kinds = table[codes]
    kinds[ends] = BREAK
    white = (kinds == SPACE) | (kinds == BLANK)
    after = np.append(white[1:] | (kinds[1:] == BREAK), True)
    letters = np.append(codes, np.zeros(2, dtype=codes.dtype))
    apostrophe = np.flatnonzero(codes == ord("'"))
    first, second = letters[apostrophe + 1], letters[apostrophe + 2]
    kinds[white & after] = RUN
    kinds[apostrophe[np.isin(first, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
    for a, b in LONG_ENDINGS:
        kinds[apostrophe[(first == ord(a)) & (second == ord(b))]] = LONG
    of_kind, compose, maps, starts = _automaton()
    scanned = _prefix_scan(of_kind[kinds], compose)
    state = np.full(len(codes), FREE, dtype=np.uint8)
    state[1:] = maps[scanned[:-1], FREE]
    return starts[state, kinds]


def piece_bounds(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(raw, starts, ends, cuts): the texts' UTF-8 bytes, the places of all pieces in
    them, and for each text the number of pieces before it; the last cut is their total."""
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
    begins = np.flatnonzero(piece_starts(codes, breaks))
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    at = np.concatenate([[0], np.cumsum(width)])[np.append(begins, len(codes))]
    inside = np.ones(len(begins), dtype=bool)
    last = np.searchsorted(begins, breaks)
    inside[last] = False
    cuts = np.concatenate([[0], last - np.arange(len(texts))])
    raw = np.frombuffer(joined.encode(), dtype=np.uint8)
    return raw, at[:-1][inside], at[1:][inside], cuts


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of least rank, leftmost first, until none is known.

    A heap of pairs over a linked list: n log n, also for a piece of a megabyte.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n

    def pair(i: int) -> tuple[int, int, int] | None:
        j = ends[i]
        if j >= n:
            return None
        rank = ranks.get(piece[i : ends[j]])
        return None if rank is None else (rank, i, ends[j])

    heap = [p for p in map(pair, range(n)) if p]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or ends[i] >= n or ends[ends[i]] != end:
            continue
        alive[ends[i]] = False
        ends[i] = end
        if end < n:
            before[end] = i
        for k in (before[i], i):
            if k >= 0 and (found := pair(k)):
                heapq.heappush(heap, found)
    return [ranks[piece[i : ends[i]]] for i in range(n) if alive[i]]


class PieceIds:
    """Piece to its ids as little-endian bytes; remembers the short ones."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.known: dict[bytes, bytes] = {}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # Every pair of tokens that together are a token, by the pair, with its rank.
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.pairs, self.merged = np.array(sorted(pairs), dtype=np.int64).T.copy()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, NONE where they are no token together."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.merged[at], NONE)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """merge() of many short pieces side by side, one merge of each at a time."""
        sizes = np.array([len(p) for p in pieces])
        tokens = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        rank = np.full(len(tokens), NONE)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self._rank(tokens[inner], tokens[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(tokens):
            firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, firsts)
            spans = np.diff(np.append(firsts, len(tokens)))
            least = np.repeat(least, spans)
            over = least == NONE
            if over.any():
                done.append((owner[over], tokens[over]))
                tokens, owner, rank, least = (x[~over] for x in (tokens, owner, rank, least))
                if not len(tokens):
                    break
            at = np.flatnonzero(rank == least)
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]  # the leftmost of each
            tokens[at] = rank[at]
            kept = np.ones(len(tokens), dtype=bool)
            kept[at + 1] = False
            at = (np.cumsum(kept) - 1)[at]
            tokens, owner, rank = tokens[kept], owner[kept], rank[kept]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(tokens) - 1)
                joined = (owner[left] == owner[right]) & (left < right)
                rank[left] = np.where(joined, self._rank(tokens[left], tokens[right]), NONE)
        owners = np.concatenate([o for o, _ in done])
        order = np.argsort(owners, kind="stable")
        raw = np.concatenate([t for _, t in done])[order].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(np.bincount(owners, minlength=len(pieces)))).tolist()]
        return list(map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:])))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each). Equal pieces are looked up once,
        and those not met before are merged in one go."""
        raw, starts, ends, cuts = piece_bounds(texts)
        first, place = equal_slices(raw, starts, ends)
        whole = raw.tobytes()
        words = list(map(whole.__getitem__, map(slice, starts[first].tolist(), ends[first].tolist())))
        new = [w for w in words if w not in self.known]
        short = [w for w in new if len(w) <= CACHED_BYTES]
        if short:
            self.known.update(zip(short, self.merge_all(short), strict=True))
        for word in new:
            if len(word) > CACHED_BYTES:
                self.known[word] = np.array(merge(word, self.ranks), dtype="<u4").tobytes()
        ids, sizes = gather([self.known[w] for w in words], place)
        # Frequent pieces come early; once the memory is full, later ones are rare.
        room = CACHED_PIECES - len(self.known) + len(new)
        for number, word in enumerate(new):
            if number >= room or len(word) > CACHED_BYTES:
                del self.known[word]
        return ids, sums_between(sizes, cuts)


@cache
def _piece_ids(ranks: bytes) -> PieceIds:
    """One per Python worker, kept for the tasks that follow."""
    return PieceIds(parse_ranks(ranks))


def encode(docs: DataFrame, ranks: bytes, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Token ids of every whole text, with where each token ends.

    Returns ``id_column``, ``ids array<int>`` and ``ends array<int>``: the end of each
    token in the text's UTF-8 bytes, so that tokens i..j decode to bytes
    ``ends[i-1]..ends[j]``. ``ranks`` is the content of a rank file.

    A null text counts as an empty one: no ids. Repeated rows are encoded each. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema[id_column].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _piece_ids(shared.value)
        table = known.ranks
        width = np.zeros(max(table.values()) + 1, dtype=np.int32)
        width[list(table.values())] = [len(t) for t in table]
        for batch, texts in text_chunks(batches, "_text"):
            ids, sizes = known.encode(texts)
            ids = ids.astype(np.int32)
            total = np.cumsum(width[ids], dtype=np.int64)
            before = np.concatenate([[0], total])[np.cumsum(sizes) - sizes]
            ends = (total - np.repeat(before, sizes)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), list_array(ids, sizes), list_array(ends, sizes)], ["_id", "ids", "ends"]
            )

    schema = T.StructType([T.StructField("_id", kind)])
    schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("ends", T.ArrayType(T.IntegerType()))
    plain = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    return plain.mapInArrow(run, schema).withColumnRenamed("_id", id_column)


def decoder(spark: SparkSession, ranks: bytes):
    """A column function from a list of ids to the bytes that they stand for.

    A null list gives null. An id outside of the vocabulary raises.
    """
    shared = spark.sparkContext.broadcast(ranks)

    @F.arrow_udf(T.BinaryType())
    def to_bytes(column: pa.Array) -> pa.Array:
        words = _token_bytes(shared.value)
        lists = (column[i].values for i in range(len(column)))
        joined = (None if x is None else b"".join(map(words.__getitem__, x.to_numpy().tolist())) for x in lists)
        return pa.array(joined, type=pa.binary())

    return to_bytes


@cache
def _token_bytes(ranks: bytes) -> dict[int, bytes]:
    return {i: t for t, i in parse_ranks(ranks).items()}


def decode(encoded: DataFrame, ranks: bytes, ids: str = "ids") -> DataFrame:
    """Add ``decoded binary``: the bytes of the ids of each row; see decoder()."""
    return encoded.withColumn("decoded", decoder(encoded.sparkSession, ranks)(F.col(ids)))


@F.arrow_udf(T.StringType())
def ids_sha256(column: pa.Array) -> pa.Array:
    """SHA-256 of the ids as little-endian unsigned 32-bit integers."""
    rows = (column[i].values.to_numpy().astype("<u4").tobytes() for i in range(len(column)))
    return pa.array([hashlib.sha256(r).hexdigest() for r in rows], type=pa.string())


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, decode the ids, digest both."""
    ranks = public_file(VOCABULARY)
    coded = encode(documents(spark, sf_dir), ranks)
    # Both functions of the ids are asked for together, so one Python worker runs them.
    both = coded.select("doc_id", "ids", ids_sha256("ids").alias("ids_sha256"), decoder(spark, ranks)("ids").alias("decoded"))
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

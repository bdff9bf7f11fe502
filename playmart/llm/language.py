"""Language-model scores: counts of n-grams in sharded tries, learned and asked by Spark.

Documents are read once and cut into chunks. A chunk sends each of its different words to a
shard of words, which gives every word an id and answers with that and with its count in
the documents that train the model. Then, order by order, a chunk sends its different
n-grams with their counts to shards. A shard adds up the counts of all chunks, builds a trie
of its n-grams (``trie.py``), looks up those of each chunk and answers with codes of their
probabilities. The chunk turns the answers into the scores of its documents.

An n-gram goes by the hash of its context, and by that of its last word also if the context
is frequent, which the answers of the order before have told: so no context, however
frequent, gathers in one shard. Both sides meet in packed columns, a row for each chunk and
shard. Chunks lie in a table bucketed by chunk, so that answers come to them.

The probability of w after a context h that was seen C times, c of them with w, is
(c + STRENGTH * p') / (C + STRENGTH), where p' is that of w after h without its first word;
below the shortest context lies the base, (c + 0.1) / (N + 0.1 (V + 1)). A trie stores
c / (C + STRENGTH).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from playmart.llm.common import bound_batches, documents, equal_slices, text_chunks
from playmart.llm.trie import Trie, changes, probabilities, quantise
from playmart.operators import Scratch

ORDER = 3
#: Weight of the shorter context, in occurrences of the longer one.
STRENGTH = 4.0
ADDED = 0.1
HELD_OUT_EVERY = 10
#: Characters of a chunk, at least; and tokens that a shard takes, on average. The number of
#: packed rows is that of chunks times that of shards: let both grow with the executors'
#: memory on inputs of many TB.
CHUNK_CHARS, SHARD_TOKENS = 5_000_000, 1_000_000
#: A context seen more often than this spreads over all shards.
FREQUENT = 250_000
#: What ends a text, as a word; no word holds white space.
END = b" "
LEVEL = 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True

DOCS = "chunk bigint, keys array<string>, sizes array<int>, trains array<boolean>, tokens binary"
RAW = f"{DOCS}, by_hash binary, words binary"
WITH_IDS = f"{DOCS}, ids binary, counts binary"
ANSWERS = "shard int, chunk bigint, part int, answer binary"
SCORES = "key string, n_tokens bigint, n_known bigint, base_score double, score double"
BLOB = "shard int, chunk bigint, part int, grams binary"


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers, byte by byte of all of them, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    size = 4 if width <= 4 else 8
    octets = values.astype(f"<u{size}").view(np.uint8).reshape(-1, size)
    planes = np.ascontiguousarray(octets[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=LEVEL).compress(planes)


def unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), dtype=np.uint8).reshape(width, -1)
    values = planes[0].astype(np.int64)
    for k in range(1, width):
        values |= planes[k].astype(np.int64) << 8 * k
    return values


def join(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def split(joined: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(joined):
        size = int.from_bytes(joined[at : at + 4], "little")
        parts.append(joined[at + 4 : at + 4 + size])
        at += 4 + size
    return parts


def pack_grams(columns: list[np.ndarray], counts: np.ndarray, totals: np.ndarray) -> bytes:
    """Sorted n-grams by differences, their counts, and a number for each context."""
    parts, new = [], np.zeros(len(counts), dtype=bool)
    new[:1] = True
    for column in columns:
        steps = np.diff(column, prepend=0)
        parts.append(pack(np.where(new, column, steps)))
        new = new | (steps != 0)
        new[:1] = True
    return join([*parts, pack(counts), pack(totals)])


def unpack_grams(packed: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    *parts, counts, totals = map(unpack, split(packed))
    columns, new = [], np.zeros(len(counts), dtype=bool)
    new[:1] = True
    for steps in parts:
        sums, begin = np.cumsum(steps), np.flatnonzero(new)
        column = sums - np.repeat(sums[begin] - steps[begin], np.diff(np.append(begin, len(steps))))
        columns.append(column)
        new = new.copy()
        new[1:] |= column[1:] != column[:-1]
    return columns, counts, totals


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row."""
    value = np.full(len(columns[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for column in columns:
        value = (value ^ column.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(29)
        value = value * np.uint64(0x94D049BB133111EB)
        value ^= value >> np.uint64(32)
    return value


def ranked(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, of so many bits, in order, and the place of each key.

    Sorting keys with their positions in one integer is several times faster than sorting
    positions by key.
    """
    own = len(keys).bit_length()
    if bits + own > 64:
        return np.unique(keys, return_inverse=True)
    both = keys.astype(np.uint64) << np.uint64(own) | np.arange(len(keys), dtype=np.uint64)
    both.sort()
    at = (both & np.uint64((1 << own) - 1)).astype(np.int64)
    both >>= np.uint64(own)
    new = np.ones(len(both), dtype=bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    place = np.empty(len(both), dtype=np.int64)
    place[at] = np.cumsum(new) - 1
    return both[new].astype(np.int64), place


def paired(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, place): the different pairs in order, and the place of each pair."""
    bits = int(right.max(initial=0)).bit_length()
    all_bits = int(left.max(initial=0)).bit_length() + bits
    if all_bits < 64:
        pairs, place = ranked(left << bits | right, all_bits)
        return pairs >> bits, pairs & ((1 << bits) - 1), place
    lefts, own = np.unique(left, return_inverse=True)
    rights, other = np.unique(right, return_inverse=True)
    own, other, place = paired(own, other)
    return lefts[own], rights[other], place


# --- from documents to chunks -----------------------------------------------------------


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, tokens, sizes): hashes of the different words, in order; the tokens of all
    texts as places among them, an end after each text; and the numbers of tokens."""
    raws = [t.encode() for t in texts]
    raw = _LOWER[np.frombuffer(b"\n".join(raws), dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(~_WHITE[raw], prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    lengths = np.array([len(r) + 1 for r in raws])
    sizes = np.diff(np.searchsorted(starts, np.cumsum(lengths) - lengths), append=len(starts))
    first, place = equal_slices(raw, starts, ends) if len(starts) else (starts, starts)
    own = [xxhash.xxh3_64_intdigest(raw[s:e].tobytes()) for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    hashes, same = np.unique(np.array([*own, xxhash.xxh3_64_intdigest(END)], dtype=np.uint64), return_inverse=True)
    tokens = np.full(len(starts) + len(texts), same[-1], dtype=np.uint32)
    tokens[np.arange(len(starts)) + np.repeat(np.arange(len(texts)), sizes)] = same[:-1][place]
    return hashes, tokens, sizes + 1


def _chunk(chunk: int, keys: list, trains: list[bool], blocks: list[tuple]) -> dict:
    """One chunk of blocks of texts (``_tokens``). Its words stand by frequency in the
    tokens, whose packing then takes less, and by hash where they are sent."""
    hashes, same = np.unique(np.concatenate([h for h, _, _ in blocks]), return_inverse=True)
    starts = np.cumsum([0, *[len(h) for h, _, _ in blocks]])
    tokens = np.concatenate([same[start : start + len(h)][t] for start, (h, t, _) in zip(starts[:-1], blocks, strict=True)])
    sizes = np.concatenate([s for _, _, s in blocks])
    counts = np.bincount(tokens[np.repeat(np.array(trains, dtype=bool), sizes)], minlength=len(hashes))
    rank = np.empty(len(hashes), dtype=np.int64)
    rank[np.argsort(-np.bincount(tokens, minlength=len(hashes)), kind="stable")] = np.arange(len(hashes))
    return {
        "chunk": chunk,
        "keys": keys,
        "sizes": sizes,
        "trains": trains,
        "tokens": pack(rank[tokens]),
        "by_hash": pack(rank),
        "words": join([hashes.tobytes(), pack(counts)]),  # hashes do not compress
    }


def _chunks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, chars: int) -> Iterator[pa.RecordBatch]:
    """Texts are taken apart in blocks of CHUNK_CHARS of ``common.py``, of which a chunk
    holds the tokens only."""
    from pyspark import TaskContext

    task, number, size = TaskContext.get().partitionId(), 0, 0
    keys, trains, blocks = [], [], []
    for batch, texts in text_chunks(batches, "text"):
        keys += batch.column("key").to_pylist()
        trains += batch.column("train").to_pylist()
        blocks.append(_tokens(texts))
        size += sum(map(len, texts))
        if size >= chars:
            yield pa.RecordBatch.from_pylist([_chunk(task << 33 | number, keys, trains, blocks)], schema)
            keys, trains, blocks, number, size = [], [], [], number + 1, 0
    if keys:
        yield pa.RecordBatch.from_pylist([_chunk(task << 33 | number, keys, trains, blocks)], schema)


# --- words ------------------------------------------------------------------------------


def _word_shards(batches: Iterator[pa.RecordBatch], schema: pa.Schema, shards: int) -> Iterator[pa.RecordBatch]:
    """The words of each chunk by ranges of their hashes."""
    bounds = np.array([(s << 64) // shards for s in range(shards)], dtype=np.uint64)
    for batch in batches:
        for chunk, words in zip(batch.column("chunk").to_pylist(), batch.column("words").to_pylist(), strict=True):
            raw, packed = split(words)
            hashes, counts = np.frombuffer(raw, dtype=np.uint64), unpack(packed)
            cuts = np.append(np.searchsorted(hashes, bounds), len(hashes))
            rows = [
                {"shard": s, "chunk": chunk, "part": 0, "grams": join([hashes[a:b].tobytes(), pack(counts[a:b])])}
                for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                if a < b
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)


def _count_words(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """For each chunk the rank of its words in the shard, the most frequent first, and their
    counts in training."""
    chunks, packed = table.column("chunk").to_pylist(), table.column("grams").to_pylist()
    parts = [split(p) for p in packed]
    hashes = [np.frombuffer(raw, dtype=np.uint64) for raw, _ in parts]
    known, place = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.zeros(len(known), dtype=np.int64)
    np.add.at(counts, place, np.concatenate([unpack(c) for _, c in parts]))
    rank = np.empty(len(known), dtype=np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(known))
    facts = {"shard": table.column("shard")[0].as_py(), "seen": int((counts > 0).sum()), "tokens": int(counts.sum())}
    rows, at = [], 0
    for chunk, own in zip(chunks, hashes, strict=True):
        mine = place[at : at + len(own)]
        at += len(own)
        rows.append({"chunk": chunk, "part": 1, "answer": join([pack(rank[mine]), pack(counts[mine])]), **facts})
    return pa.Table.from_pylist(rows, schema)


# --- chunks with ids --------------------------------------------------------------------


def _answers(table: pa.Table, part: int) -> list[tuple[int, list[np.ndarray]]]:
    """(shard, answer) of one part, by shard."""
    rows = zip(*(table.column(c).to_pylist() for c in ("part", "shard", "answer")), strict=True)
    return sorted(((shard, [unpack(p) for p in split(answer)]) for p, shard, answer in rows if p == part), key=lambda x: x[0])


def _with_ids(chunk: pa.Table, words: pa.Table, schema: pa.Schema, shards: int) -> pa.Table:
    """A chunk's tokens as places among its words' ids, which rise from 1; and the counts.

    The shards take turns in the ids, so frequent words have small ones, which packs n-grams
    and tries better.
    """
    row = chunk.to_pylist()[0]
    answers = _answers(words, 1)
    by_hash = unpack(row["by_hash"])
    ids, counts = np.empty((2, len(by_hash)), dtype=np.int64)
    ids[by_hash] = np.concatenate([own * shards + shard + 1 for shard, (own, _) in answers])
    counts[by_hash] = np.concatenate([c for _, (_, c) in answers])
    order = np.argsort(ids)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    ids, counts = ids[order], counts[order]
    made = {c: row[c] for c in ("chunk", "keys", "sizes", "trains")}
    made |= {"tokens": pack(rank[unpack(row["tokens"])]), "ids": pack(np.diff(ids, prepend=0)), "counts": pack(counts)}
    return pa.Table.from_pylist([made], schema)


class Chunk:
    """A chunk's documents as sequences of places among its words, in the order of ids."""

    def __init__(self, row: dict, ends: int, order: int):
        #: Place 0 is the beginning of a text, id 0, seen once for each text that ends.
        self.ids = np.concatenate([[0], np.cumsum(unpack(row["ids"]))])
        self.counts = np.concatenate([[ends], unpack(row["counts"])])
        self.tokens = unpack(row["tokens"]) + 1
        self.sizes = np.array(row["sizes"])
        self.number = row["chunk"]
        self.training = np.repeat(np.array(row["trains"], dtype=bool), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        self.first = np.zeros(len(self.tokens), dtype=bool)
        self.first[starts] = True
        # By order: the n-grams as pairs of the place of a context among those of the order
        # below and a word; and the place of each token's n-gram among them.
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.places = {1: self.tokens}
        for n in range(2, order + 1):
            # Contexts are counted from 1; 0 is that of a first token, beginnings only.
            before = np.zeros_like(self.tokens)
            before[1:] = self.places[n - 1][:-1] + (n > 2)
            before[self.first] = 0
            left, right, place = paired(before, self.tokens)
            self.grams[n], self.places[n] = (left, right), place

    def columns(self, n: int) -> list[np.ndarray]:
        """The ids of all n-grams, a column for each word, rows in their order."""
        return [*self.contexts(n), self.ids[self.grams[n][1]]]

    def contexts(self, n: int) -> list[np.ndarray]:
        left = self.grams[n][0]
        if n == 2:
            return [self.ids[left]]
        return [np.append(0, c)[left] for c in self.columns(n - 1)]

    def context_counts(self, n: int, answers: dict[int, np.ndarray]) -> np.ndarray:
        """How often the context of each n-gram was seen in training, from the answers of
        the order below."""
        left = self.grams[n][0]
        if n == 2:
            return self.counts[left]
        shares = probabilities(answers[n - 1])
        seen = np.rint(shares * (self.context_counts(n - 1, answers) + STRENGTH)).astype(np.int64)
        return np.append(self.counts[0], seen)[left]

    def dealt(self, n: int, answers: dict[int, np.ndarray], shards: int) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
        """(order, shard, columns, totals): the n-grams by shard and then by ids, and the
        counts of those contexts that spread."""
        columns, seen = self.columns(n), self.context_counts(n, answers)
        totals = np.where(seen > FREQUENT, seen, 0)
        spread = np.where(totals > 0, mixed(columns), np.uint64(0))
        shard = (mixed(columns[:-1]) ^ spread) % np.uint64(shards)
        order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
        return order, shard[order].astype(np.int64), [c[order] for c in columns], totals[order]


def _gram_shards(chunk: Chunk, n: int, answers: dict[int, np.ndarray], shards: int) -> Iterator[dict]:
    order, shard, columns, totals = chunk.dealt(n, answers, shards)
    counts = np.bincount(chunk.places[n][chunk.training], minlength=len(order))[order]
    cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = [c[a:b] for c in columns]
        contexts = changes(own)[-2]
        yield {"shard": int(shard[a]), "chunk": chunk.number, "part": n, "grams": pack_grams(own, counts[a:b], totals[a:b][contexts])}


def _received(chunk: Chunk, answers: pa.Table, upto: int, shards: int) -> dict[int, np.ndarray]:
    """The codes of the chunk's n-grams by order."""
    found: dict[int, np.ndarray] = {}
    for n in range(2, upto + 1):
        found[n] = _codes(chunk, answers, found, n, shards)
    return found


def _codes(chunk: Chunk, answers: pa.Table, below: dict[int, np.ndarray], n: int, shards: int) -> np.ndarray:
    """The answers of one order at the places of the n-grams that were asked for."""
    order = chunk.dealt(n, below, shards)[0]
    codes = np.zeros(len(order), dtype=np.int64)
    codes[order] = np.concatenate([a[0] for _, a in _answers(answers, n)])
    return codes


def _ask_pairs(chunk: pa.Table, schema: pa.Schema, ends: int, shards: int) -> pa.Table:
    own = Chunk(chunk.to_pylist()[0], ends, 2)
    return pa.Table.from_pylist(list(_gram_shards(own, 2, {}, shards)), schema)


def _ask(chunk: pa.Table, answers: pa.Table, schema: pa.Schema, n: int, ends: int, shards: int) -> pa.Table:
    own = Chunk(chunk.to_pylist()[0], ends, n)
    found = _received(own, answers, n - 1, shards)
    return pa.Table.from_pylist(list(_gram_shards(own, n, found, shards)), schema)


def _answer(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """Build the trie of a shard and look up the n-grams of every chunk."""
    chunks = table.column("chunk").to_pylist()
    parts = [unpack_grams(p) for p in table.column("grams").to_pylist()]
    columns = [np.concatenate(c) for c in zip(*(columns for columns, _, _ in parts), strict=True)]
    first, place = ranked(columns[0], int(columns[0].max()).bit_length())
    context = [first]
    for column in columns[1:-1]:
        left, right, place = paired(place, column)
        context = [c[left] for c in context] + [right]
    told = np.zeros(len(context[0]), dtype=np.int64)
    firsts = np.concatenate([changes(c)[-2] for c, _, _ in parts])
    np.maximum.at(told, place[firsts], np.concatenate([t for _, _, t in parts]))
    left, right, place = paired(place, columns[-1])
    counts = np.zeros(len(left), dtype=np.int64)
    np.add.at(counts, place, np.concatenate([c for _, c, _ in parts]))
    totals = np.bincount(left, weights=counts, minlength=len(told))
    shares = counts / (np.where(told > 0, told, totals)[left] + STRENGTH)
    different = [*[c[left] for c in context], right]
    seen = counts > 0
    trie = Trie([c[seen] for c in different], quantise(shares[seen]))
    codes = trie.find(different)[place]
    shard, part = table.column("shard")[0].as_py(), table.column("part")[0].as_py()
    rows, at = [], 0
    for chunk, (_, own, _) in zip(chunks, parts, strict=True):
        rows.append({"shard": shard, "chunk": chunk, "part": part, "answer": join([pack(codes[at : at + len(own)])])})
        at += len(own)
    return pa.Table.from_pylist(rows, schema)


def _scores(chunk: pa.Table, answers: pa.Table, schema: pa.Schema, order: int, ends: int, shards: int, tokens: int, seen: int) -> pa.Table:
    row = chunk.to_pylist()[0]
    own = Chunk(row, ends, order)
    found = _received(own, answers, order, shards)
    counts = own.counts[own.tokens]
    p = (counts + ADDED) / (tokens + ADDED * (seen + 1))
    base = np.log10(p)
    for n in range(2, order + 1):
        # By n-gram first, as an n-gram has one probability wherever it occurs.
        weight = STRENGTH / (own.context_counts(n, found) + STRENGTH)
        share = probabilities(found[n])
        p = share[own.places[n]] + weight[own.places[n]] * p
    starts = np.cumsum(own.sizes) - own.sizes
    columns = {
        "key": row["keys"],
        "n_tokens": own.sizes,
        "n_known": np.add.reduceat((counts > 0).astype(np.int64), starts),
        "base_score": np.add.reduceat(base, starts),
        "score": np.add.reduceat(np.log10(p), starts),
    }
    return pa.table({k: pa.array(v, schema.field(k).type) for k, v in columns.items()}, schema)


# --- the jobs ---------------------------------------------------------------------------


def _one(function: Callable) -> Callable:
    return lambda table: function(table)


def _two(function: Callable) -> Callable:
    return lambda left, right: function(left, right)


def _mapped(function: Callable, schema: str, *rest) -> Callable:
    """``function`` of one or two tables or an iterator, with its schema and parameters."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return lambda *tables: function(*tables, arrow, *rest)


class ChunkTable:
    """A table bucketed by chunk, for as long as a job needs it."""

    def __init__(self, scratch: Scratch, df: DataFrame, buckets: int):
        self.spark, self.buckets = scratch.spark, buckets
        self.name = f"playmart_chunks_{uuid.uuid4().hex}"
        write = df.write.format("parquet").option("path", scratch.path("bucketed"))
        write.bucketBy(buckets, "chunk").sortBy("chunk").saveAsTable(self.name)
        self.rows = self.spark.table(self.name)

    def with_answers(self, answers: DataFrame, function: Callable, schema: str) -> DataFrame:
        """Apply a function to every chunk and its answers; only these move."""
        moved = answers.select("chunk", "shard", "part", "answer").repartition(self.buckets, "chunk")
        both = self.rows.groupBy("chunk").cogroup(moved.groupBy("chunk"))
        return both.applyInArrow(_two(function), schema)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")


def score(
    docs: DataFrame,
    train: Column,
    scratch: Scratch,
    key: str = "doc_id",
    order: int = ORDER,
    chunk_chars: int = CHUNK_CHARS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """The ``key`` of every row with the log10 probability of its text under the base
    (``base_score``) and under the model (``score``), both learned from the rows for which
    ``train`` holds, the number of its tokens, of those among them that occur in training,
    and of all training tokens.

    Words are told apart by 64-bit hashes. Texts are read whole; a very long one is a chunk
    of its own. A null or empty text is an end alone. Rows count as often as they occur, keys
    may be null or repeat. A row for which ``train`` is null does not train. Without training
    rows each token has the base's probability, 1. An empty table gives an empty one. Columns
    other than the key and ``text`` are passed over.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).cast("string").alias("key"), "text", F.coalesce(train, F.lit(False)).alias("train"))
    raw = scratch.write("chunks", rows.mapInArrow(_mapped(_chunks, RAW, chunk_chars), RAW))
    sizes = F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("tokens")
    training = F.sum(F.size(F.filter("trains", lambda t: t))).alias("ends")
    facts = raw.agg(F.count(F.lit(1)).alias("chunks"), sizes, training).first()
    ends, cores = facts["ends"] or 0, spark.sparkContext.defaultParallelism
    shards = max(cores, ceil((facts["tokens"] or 0) / shard_tokens))
    buckets = max(1, min(facts["chunks"], max(2 * cores, facts["chunks"] // 4)))

    asked = raw.select("chunk", "words").mapInArrow(_mapped(_word_shards, BLOB, shards), BLOB)
    counted = f"{ANSWERS}, seen bigint, tokens bigint"
    words = scratch.write("words", asked.groupBy("shard").applyInArrow(_one(_mapped(_count_words, counted)), counted))
    told = words.select("shard", "seen", "tokens").distinct().agg(F.sum("tokens").alias("tokens"), F.sum("seen").alias("seen")).first()
    tokens, seen = told["tokens"] or 0, told["seen"] or 0

    by_chunk = raw.drop("words").repartition(buckets, "chunk").groupBy("chunk")
    moved = words.select("chunk", "shard", "part", "answer").repartition(buckets, "chunk").groupBy("chunk")
    chunks = ChunkTable(scratch, by_chunk.cogroup(moved).applyInArrow(_two(_mapped(_with_ids, WITH_IDS, shards)), WITH_IDS), buckets)
    scratch.drop("chunks")
    scratch.drop("words")

    answers: DataFrame | None = None
    for n in range(2, order + 1):
        if answers is None:
            asked = chunks.rows.groupBy("chunk").applyInArrow(_one(_mapped(_ask_pairs, BLOB, ends, shards)), BLOB)
        else:
            asked = chunks.with_answers(answers, _mapped(_ask, BLOB, n, ends, shards), BLOB)
        found = scratch.write(f"answers{n}", asked.groupBy("shard").applyInArrow(_one(_mapped(_answer, ANSWERS)), ANSWERS))
        answers = found if answers is None else answers.unionByName(found)
    last = _mapped(_scores, SCORES, order, ends, shards, tokens, seen)
    scored = scratch.write("scores", chunks.with_answers(answers, last, SCORES))
    chunks.drop()
    for name in ("bucketed", *(f"answers{n}" for n in range(2, order + 1))):
        scratch.drop(name)
    return scored.select(
        F.col("key").cast(kind).alias(key), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model that nine tenths of them train."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_EVERY == 0
    scored = score(documents(spark, sf_dir), ~held_out, Scratch(spark, "language"))
    return scored.withColumn("held_out", F.coalesce(held_out, F.lit(False)))

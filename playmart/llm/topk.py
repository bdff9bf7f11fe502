"""Exact top-k by inner product: MaxScore over the postings of vector components."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmart.llm.common import table
from playmart.operators import Scratch

TOP = 20
QUERY_STEP = 20
SCALE = 64
#: Vectors of a shard and queries of a block: what one task holds at a time.
SHARD_VECTORS, BLOCK_QUERIES = 16384, 32768
#: Vectors of a shard that is made smaller only to give every core one.
LEAST_VECTORS = 2048
#: Vectors that share bounds, and those that a query meets before it has a threshold.
RANGE_VECTORS, FIRST_VECTORS = 128, 256
#: Queries whose bounds are computed together, and terms probed between two looks at them.
QUERIES_TOGETHER, PROBED_TERMS = 32, 8
#: Threshold of a query that has fewer than k results so far.
NONE = -(1 << 62)


def _exact_type(bound: float) -> type:
    """The fastest type in which sums of whole numbers up to ``bound`` are exact."""
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


class Shard:
    """Inverted lists of a set of vectors, by term (component number).

    Vectors use most terms, so a list is an array with a zero for a vector that is not in
    it. The largest and least value of each term are kept for ranges of vectors, and
    for segments of ranges, each as long as all before it: a query's threshold grows
    from one segment to the next. ``postings`` counts those traversed in essential
    lists, those probed, and all that the queries had.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        # Neighbouring ids may be alike; a fixed shuffle makes the first segments a fair sample.
        order = order[np.random.default_rng(0).permutation(len(order))]
        self.ids, self.values = ids[order], values[order]
        self.largest = float(np.abs(self.values).max(initial=0))
        self.postings = np.zeros(3, dtype=np.int64)
        self.segments = []
        start, count = 0, len(ids)
        while start < count:
            end = min(count, max(FIRST_VECTORS, 2 * start))
            begins = np.arange(start, end, RANGE_VECTORS)
            part = self.values[start:end]
            most = np.maximum.reduceat(part, begins - start, axis=0)
            least = np.minimum.reduceat(part, begins - start, axis=0)
            sizes = np.diff(np.append(begins, end))
            self.segments.append((start, end, np.repeat(np.arange(len(sizes)), sizes), most, least))
            start = end

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query numbers, ids, scores): the k highest scores of each query but its
        own, ties to smaller ids."""
        count, width = queries.shape
        kind = _exact_type(width * self.largest * float(np.abs(queries).max(initial=0)))
        lists, asked = np.ascontiguousarray(self.values.T.astype(kind)), queries.astype(kind)
        best = [(np.empty(0, dtype=np.int64),) * 2] * count
        for segment in self.segments:
            most, least = segment[3], segment[4]
            for first in range(0, count, QUERIES_TOGETHER):
                some = queries[first : first + QUERIES_TOGETHER]
                bounds = np.maximum(some[:, None] * most, some[:, None] * least)
                for n, of_ranges in enumerate(bounds, first):
                    best[n] = self._meet(segment, lists, asked[n], queries[n], of_ranges, own[n], k, best[n])
        sizes = [len(ids) for ids, _ in best]
        ids, scores = (np.concatenate(x) if count else np.empty(0, dtype=np.int64) for x in (zip(*best) if count else ((), ())))
        return np.repeat(np.arange(count), sizes), ids, scores

    def _meet(self, segment, lists, asked, query, bounds, own, k, best):
        """The best results of one query after a segment.

        The terms stand by what they can add to a score there at most. The last of them
        together cannot reach the threshold: a vector that is in no list before those,
        the essential ones, is out of the race. Essential lists are traversed; the other
        terms are probed for the vectors that stay competitive by their range's bounds.
        """
        start, end, range_of, _, _ = segment
        width = len(query)
        threshold = int(best[1][-1]) if len(best[1]) == k else NONE
        order = np.argsort(-bounds.max(axis=0, initial=0), kind="stable")
        tops = np.maximum(bounds.max(axis=0), 0)[order]
        essential = int((np.cumsum(tops[::-1])[::-1] >= threshold).sum())
        # rest[r, i]: what the terms from i on add to a score in range r at most.
        rest = np.zeros((len(bounds), width + 1), dtype=np.int64)
        rest[:, :-1] = np.cumsum(bounds[:, order[::-1]], axis=1)[:, ::-1]
        terms = order[:essential]
        scores = (asked[terms] @ lists[terms, start:end]).astype(np.int64)
        place = np.flatnonzero(scores + rest[range_of, essential] >= threshold)
        partial = scores[place]
        probed = 0
        for first in range(essential, width, PROBED_TERMS):
            if not len(place):
                break
            some = order[first : first + PROBED_TERMS]
            probed += len(place) * len(some)
            partial = partial + self.values[start + place[:, None], some] @ query[some]
            still = partial + rest[range_of[place], min(first + PROBED_TERMS, width)] >= threshold
            place, partial = place[still], partial[still]
        self.postings += (essential * (end - start), probed, width * (end - start))
        found = self.ids[start + place]
        other = found != own
        ids, scores = np.append(best[0], found[other]), np.append(best[1], partial[other])
        if len(ids) > 4 * k:
            # Only what ties with the k-th score or beats it needs sorting.
            near = scores >= -np.partition(-scores, k - 1)[k - 1]
            ids, scores = ids[near], scores[near]
        ranked = np.lexsort((ids, -scores))[:k]
        return ids[ranked], scores[ranked]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length from a list column; shorter lists are filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy().astype(np.int64)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def usable(vector: Column) -> Column:
    """Whether the vector and all of its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def top_k(
    vectors: DataFrame,
    is_query: Column,
    scratch: Scratch,
    k: int = TOP,
    shard_vectors: int = SHARD_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k highest inner products of each query with all other vectors.

    ``vectors`` has vec_id and ``terms array<bigint>``; ``is_query`` tells the queries by
    their vec_id. Vectors are dealt into shards and queries into blocks; each shard
    meets each block in one task, which returns at most k rows a query, and the shards'
    results are merged per query. A block is large, so vectors are copied once for every
    ``block_queries`` queries only.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Rows
    with a null vec_id or null terms take no part. Rows that repeat a vec_id count once,
    with the least terms. Missing components of shorter vectors count as zero. Scores
    are 64-bit: products must stay below 2^63. No rows give no rows.
    """
    plain = vectors.filter(F.col("vec_id").isNotNull() & F.col("terms").isNotNull())
    once = scratch.write("vectors", plain.groupBy("vec_id").agg(F.min("terms").alias("terms")))
    queries = once.filter(is_query)
    count = once.count()
    by_cores = min(vectors.sparkSession.sparkContext.defaultParallelism, ceil(count / LEAST_VECTORS))
    shards = max(1, by_cores, ceil(count / shard_vectors))
    blocks = max(1, ceil(queries.count() / block_queries))
    spread = F.xxhash64("vec_id")
    left = once.select(
        "vec_id",
        "terms",
        F.pmod(spread, F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    right = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("terms").alias("query"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(spread, F.lit(blocks)).cast("int").alias("block"),
    )

    def run(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = [(np.empty(0, dtype=np.int64),) * 3]
        if candidates.num_rows and asked.num_rows:
            values, wanted = _matrix(candidates.column("terms")), _matrix(asked.column("query"))
            width = max(values.shape[1], wanted.shape[1])
            values, wanted = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (values, wanted))
            shard = Shard(candidates.column("vec_id").to_numpy(), values)
            own = asked.column("query_id").to_numpy()
            query, ids, scores = shard.search(wanted, own, k)
            found.append((own[query], ids, scores))
        columns = (pa.array(np.concatenate(c)) for c in zip(*found, strict=True))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    keys = ["shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every twentieth vector the 20 nearest of all others, by scaled components."""
    vectors = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")))
    terms = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    scaled = vectors.select("vec_id", terms.alias("terms"))
    return top_k(scaled, F.col("vec_id") % QUERY_STEP == 0, Scratch(spark, "topk"))


OP2_SQL = f"""
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS terms
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.terms, c.terms)::BIGINT AS score
  FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {QUERY_STEP} = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY rank <= {TOP}
"""

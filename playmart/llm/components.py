"""Connected components of a graph of any size, by alternating star operations."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators import Scratch

#: Edges that one task contracts in memory, at most: some 50 bytes each.
EDGES_OF_TASK = 1_000_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    joined = down.join(least, "u")
    others = joined.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return others.unionAll(least.select("u", F.col("least").alias("v"))).distinct()


def _contracted(edges: DataFrame, roots: bool = False) -> DataFrame:
    """Each task's edges (u, v) as edges of every node to the least one that the task's
    edges connect it with: fewer edges, same components. With ``roots``, that node has an
    edge to itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        ends = pa.chunked_array([*table.column("u").chunks, *table.column("v").chunks])
        coded = ends.combine_chunks().dictionary_encode()
        # Rank the nodes, so that the least number is the least node.
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        a, b = np.split(rank[coded.indices.to_numpy()], 2)
        root = np.arange(len(order))
        while True:
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], least)
            np.minimum.at(root, root[b], least)
            root = root[root]
            if np.array_equal(root, before):
                break
        nodes = coded.dictionary.take(pa.array(order))
        others = np.flatnonzero(roots | (root != np.arange(len(root))))
        columns = [nodes.take(pa.array(others)), nodes.take(pa.array(root[others]))]
        yield pa.RecordBatch.from_arrays(columns, ["u", "v"])

    return edges.mapInArrow(run, edges.schema)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node.

    Tasks of at most EDGES_OF_TASK edges contract what they hold; star operations, whose
    number of rounds grows with the logarithm of the nodes, then connect what lies in
    different tasks, until a round changes nothing. Edges that fit one task need no
    round. Each round is written, so a lost executor costs no earlier round. Only a
    count and a checksum reach the driver. Ids may be of any type with an order. Edges
    of a node with itself or with null are ignored.
    """
    now = scratch.write(f"{name}-0", edges.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")))
    seen, turn = None, 0
    while True:
        check = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if not check[0] or check == seen:
            break
        seen, turn, tasks = check, turn + 1, ceil(check[0] / EDGES_OF_TASK)
        if tasks == 1:
            now = scratch.write(f"{name}-{turn}", _contracted(now.coalesce(1), roots=True))
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if turn == 1:
            now = _contracted(now.repartition(tasks))
        now = scratch.write(f"{name}-{turn}", _small_star(_large_star(now)))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)

"""Near duplicates by Jaccard similarity of word shingles: an exact T-occurrence join.

1. Every document becomes a set of shingle hashes. Documents with equal sets are one
   node from here on, so a group of copies weighs as much as one document.
2. Each set is cut by ranges of hashes into a few more parts than two similar sets of
   its size can differ in shingles, so similar sets have parts in common. A part is known
   by a hash of its shingles. Inverted lists of the parts give candidate pairs; the few
   lists that are long give each member one edge to the list's first member.
3. Components of the candidates share a task, large ones in blocks. There a T-occurrence
   search over whole sets finds the links: for each set, the short inverted lists are
   merged with counts, the long ones are probed for what has been met often enough, and
   the sets that reach the required overlap are linked (DivideSkip).
4. What the first blocks of a large component leave unconnected meets again, block by
   block, but only sets that have a part in common with one of another group there.
5. Components of the links are the groups of near duplicates.

The parts and the candidates only say where to look. No link is missed: every linked
pair shares a task, except two sets that are connected by other links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.common import HASHED_CHARS, bound_batches, documents, equal_slices, list_array, text_chunks
from playmart.llm.components import components
from playmart.operators import Scratch
from playmart.operators.lookup import broadcast_within

#: One part in so many is there to be common beyond the first, and one to be left out.
SPARE_PARTS = 8
#: Lists of so many sets give edges to their first member instead of pairs.
LONG_LIST = 128
#: Bytes of the sets of one block, about, at 8 for a shingle; a task compares two
#: blocks at most.
BLOCK_BYTES = 1 << 20
#: Of what is left of a large component, groups of so many sets get blocks of their own.
HEAVY_COUNT = 32
#: Sides of joins that hold members of groups are broadcast up to this measured size.
MEMBER_BYTES = 64 << 20
#: Weight of the probe against the merge in the choice of long lists.
PROBE_WEIGHT = 0.0085
MIX = np.uint64(0xC2B2AE3D27D4EB4F)
SHIFT = np.uint64(29)
HALF = np.uint64(32)
ENOUGH = 1 << 20
#: No set is so large.
MOST_SHINGLES = 1 << 31


@cache
def _class_starts(share: int, of: int) -> np.ndarray:
    """The least size of each class of sizes. Sizes that sets of a similarity of share / of
    can have lie in one class or in two that follow each other."""
    starts = [1]
    while starts[-1] < MOST_SHINGLES:
        starts.append(starts[-1] * of // share + 1)
    return np.array([*starts, starts[-1] * of // share + 1])


@dataclass(frozen=True)
class Likeness:
    """Shingles of ``words`` words; similar from a Jaccard similarity of share / of on."""

    words: int = 5
    share: int = 80
    of: int = 100

    def overlap(self, size):
        """Shingles that a set of ``size`` has in common with any similar one, at least."""
        return -(-size * self.share // self.of)

    def parts(self, size, later: int = 0):
        """(class, differ, common) for the class of a size, or one of the ``later`` classes:
        similar sets of sizes up to the end of that class differ in ``differ`` shingles at
        most, and ``common`` of the first differ + common parts are the same at least."""
        starts = _class_starts(self.share, self.of)
        at = np.searchsorted(starts, size, side="right") - 1 + later
        differ = (self.of - self.share) * 2 * (starts[at + 1] - 1) // (self.of + self.share)
        return at, differ, 1 + differ // SPARE_PARTS

    def similar(self, common, a, b):
        return self.of * common >= self.share * (a + b - common)

    def least_size(self) -> int:
        """Smaller sets are similar to none but equal ones."""
        return -(-self.share // (self.of - self.share)) if self.share < self.of else MOST_SHINGLES

    def size_classes(self, size: Column) -> Column:
        """Two classes of a size; any two sizes that similar sets can have share one."""
        step = -log(self.share / self.of) if self.share < self.of else 1e-6
        lower = F.floor(F.log(size.cast("double")) / step)
        return F.array(lower, lower + 1)

    def near_sizes(self, a, b):
        return self.of * np.minimum(a, b) >= self.share * np.maximum(a, b)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: A-Z lower-cased, words between
    ASCII white space; a text of fewer words is one shingle, one without words none."""
    whole = "\n".join([*texts, ""]).encode().lower()
    raw = np.frombuffer(whole, dtype=np.uint8)
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    inside = np.concatenate([[False], ~blank, [False]])
    bounds = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = bounds[::2], bounds[1::2]
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(t.encode()) + 1 for t in texts)]))
    if not len(starts):
        return [np.empty(0, dtype=np.uint64) for _ in texts]
    first, place = equal_slices(raw, starts, ends)
    digest = xxhash.xxh3_64_intdigest
    known = [digest(whole[s:e]) for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    hashes = np.array(known, dtype=np.uint64)[place]

    def chained(columns: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(columns[0]), len(columns), dtype=np.uint64)
        for column in columns:
            out = (out ^ column) * MIX
            out ^= out >> SHIFT
        return out

    count = max(0, len(hashes) - words + 1)
    runs = chained([hashes[j : j + count] for j in range(words)]) if count else np.empty(0, dtype=np.uint64)
    out = []
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if end - begin >= words:
            out.append(np.unique(runs[begin : end - words + 1]))
        elif end > begin:
            out.append(chained([hashes[i : i + 1] for i in range(begin, end)]))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray], likeness: Likeness) -> list[np.ndarray]:
    """Hashes of parts of each set, which is sorted. Two similar sets share as many as
    ``likeness.parts`` has in common for the larger one.

    A set is cut for its class of sizes and for the next one, so that similar sets are cut
    alike once. Of parts + spare parts, d at most differ, so parts + spare - d are the same;
    if both sets leave out the last spare ones in one order of all parts, parts - d of them
    stay. The order puts large parts first: small ones are the same by chance.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    used = np.flatnonzero(sizes >= likeness.least_size())
    out = [[np.empty(0, dtype=np.uint64)] for _ in sets]
    if not len(used):
        return [x[0] for x in out]
    flat, sizes = np.concatenate([sets[i] for i in used]), sizes[used]
    owner = np.repeat(np.arange(len(used)), sizes)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_mixed(flat))])
    for later in (0, 1):
        of_class, differ, common = likeness.parts(sizes, later)
        kept = differ + common
        cuts = kept + 1 + kept // SPARE_PARTS
        begin = np.cumsum(cuts) - cuts
        part = ((flat >> HALF) * cuts.astype(np.uint64)[owner]) >> HALF
        held = np.bincount(begin[owner] + part.astype(np.int64), minlength=cuts.sum())
        end = np.cumsum(held)
        whose = np.repeat(np.arange(len(used)), cuts)
        place = (of_class[whose] << 32) + np.arange(len(whose)) - begin[whose]
        signs = _mixed((sums[end] - sums[end - held]) ^ _mixed(place.astype(np.uint64)))
        order = np.lexsort((signs, -held, whose))
        for i, b, k in zip(used.tolist(), begin.tolist(), kept.tolist(), strict=True):
            out[i].append(signs[order[b : b + k]])
    return [np.concatenate(x) for x in out]


def _mixed(values: np.ndarray) -> np.ndarray:
    out = (values + np.uint64(1)) * MIX
    out ^= out >> SHIFT
    return out * MIX


def _sets(docs: DataFrame, text: str, keys: list[str], likeness: Likeness) -> DataFrame:
    """For every document: keys, size, set_key, node and the signatures of its set."""
    schema = T.StructType([docs.schema[k] for k in keys])
    schema = schema.add("size", T.IntegerType()).add("set_key", T.BinaryType()).add("node", T.LongType())
    schema = schema.add("signs", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, text, HASHED_CHARS):
            sets = shingle_sets(texts, likeness.words)
            signs = signatures(sets, likeness)
            set_keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            nodes = np.frombuffer(b"".join(k[:8] for k in set_keys), dtype=np.int64)
            columns = [
                pa.array([len(s) for s in sets], type=pa.int32()),
                pa.array(set_keys, type=pa.binary()),
                pa.array(nodes),
                list_array(np.concatenate(signs).view(np.int64), [len(i) for i in signs]),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *columns], schema.names)

    return docs.select(*keys, text).mapInArrow(run, schema)


def _pairs_of_lists(batches: Iterator[pa.RecordBatch], likeness: Likeness) -> Iterator[pa.RecordBatch]:
    """Pairs within each list of rows (shingle, node, size) in order. The last list of
    a batch is held back for the next one, only its first member once it is long."""

    def stars(shingle: np.ndarray, node: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        others = np.unique(node)
        others = others[others != node[0]]
        if len(others):
            full = np.full(len(others), ENOUGH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(others), node[0])), pa.array(others), pa.array(full), pa.array(full)],
                ["a", "b", "shared", "need"],
            )

    def pairs(shingle: np.ndarray, node: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.append(True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1]))
        shingle, node, size = shingle[new], node[new], size[new]
        begins = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
        length = np.diff(np.append(begins, len(shingle)))
        head, length = np.repeat(begins, length), np.repeat(length, length)
        left, right, weight = [], [], []
        far = np.flatnonzero((length >= LONG_LIST) & (head != np.arange(len(head))))
        left.append(head[far])
        right.append(far)
        weight.append(np.full(len(far), ENOUGH))
        short = np.flatnonzero((length > 1) & (length < LONG_LIST))
        for step in range(1, LONG_LIST):
            to = short[short + step < head[short] + length[short]]
            if not len(to):
                break
            to = to[likeness.near_sizes(size[to], size[to + step])]
            left.append(to)
            right.append(to + step)
            weight.append(np.ones(len(to), dtype=np.int64))
        a, b = np.concatenate(left), np.concatenate(right)
        if len(a):
            need = likeness.parts(np.maximum(size[a], size[b]))[2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (node[a], node[b], np.concatenate(weight), need.astype(np.int64))],
                ["a", "b", "shared", "need"],
            )

    held, cut = [np.empty(0, dtype=np.int64)] * 3, False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [
            np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)])
            for h, c in zip(held, ("shingle", "node", "size"), strict=True)
        ]
        if cut:  # the held row is the first member of a list that is long already
            count = int(np.searchsorted(rows[0], rows[0][0], side="right"))
            yield from stars(*(r[:count] for r in rows))
            if count == len(rows[0]):
                continue
            rows, cut = [r[count:] for r in rows], False
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        if last:
            yield from pairs(*(r[:last] for r in rows))
        held = [r[last:] for r in rows]
        if len(np.unique(held[1])) >= LONG_LIST:
            yield from stars(*held)
            held, cut = [r[:1] for r in held], True
    if len(held[0]) and not cut:
        yield from pairs(*held)


def _candidates(sets: DataFrame, likeness: Likeness) -> DataFrame:
    """Edges (a, b) between nodes such that any two similar sets are connected."""
    light = sets.select(F.explode("signs").alias("shingle"), "node", "size")
    listed = light.repartition("shingle").sortWithinPartitions("shingle", "node")
    pairs = listed.mapInArrow(
        lambda batches: _pairs_of_lists(batches, likeness), "a bigint, b bigint, shared bigint, need bigint"
    )
    counted = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need"))
    return counted.filter("shared >= need").select("a", "b")


class Links:
    """Union of linked sets within a task; remembers the links that joined something."""

    def __init__(self, groups: list):
        self.parent = list(range(len(groups)))
        self.made: list[tuple[int, int]] = []
        first: dict = {}
        for i, group in enumerate(groups):
            if group is not None:
                self.parent[i] = first.setdefault(group, i)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a: int, b: int) -> None:
        left, right = self.root(a), self.root(b)
        if left != right:
            self.parent[max(left, right)] = min(left, right)
            self.made.append((a, b))


def similar_sets(sets: list[np.ndarray], likeness: Likeness, side: np.ndarray, groups: list) -> list[tuple[int, int]]:
    """Links that connect all similar sets of a task, as pairs of places.

    ``side``: 0 for the sets that search, 1 for those searched, 2 for both.
    ``groups``: what each set is known to be connected with, or None.
    """
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    searched = side[owner] > 0
    tokens, owners = flat[searched], owner[searched]
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    links = Links(groups)
    for query in np.flatnonzero(side != 1).tolist():
        own = sets[query]
        need = int(likeness.overlap(len(own)))
        begin, end = np.searchsorted(tokens, own), np.searchsorted(tokens, own, side="right")
        length = end - begin
        ranked = np.argsort(length, kind="stable")
        longest = int(length[ranked[-1]])
        many = min(need - 1, int(need / (PROBE_WEIGHT * log2(max(longest, 2)) + 1)))
        short, long = ranked[: len(ranked) - many], ranked[len(ranked) - many :]
        # Merge the short lists, counting how often each set is met.
        merged = [owners[begin[i] : end[i]] for i in short.tolist() if length[i]]
        if not merged:
            continue
        met, times = np.unique(np.concatenate(merged), return_counts=True)
        after = (met > query) if side[query] == 2 else (met != query)
        good = after & (times >= need - many) & likeness.near_sizes(sizes[met], len(own))
        met, times = met[good], times[good]
        root = links.root(query)
        apart = np.array([links.root(m) != root for m in met.tolist()], dtype=bool)
        met, times = met[apart], times[apart]
        if not len(met):
            continue
        # Probe the long lists for the sets that are left.
        if len(met) <= len(long):
            asked = own[np.sort(long)]
            for i, candidate in enumerate(met.tolist()):
                other = sets[candidate]
                at = np.minimum(np.searchsorted(other, asked), len(other) - 1)
                times[i] += np.count_nonzero(other[at] == asked)
        else:
            for i in long.tolist():
                inside = owners[begin[i] : end[i]]
                if len(inside):
                    at = np.minimum(np.searchsorted(inside, met), len(inside) - 1)
                    times += inside[at] == met
        for candidate in met[likeness.similar(times, len(own), sizes[met])].tolist():
            links.join(query, candidate)
    return links.made


def _links(dealt: DataFrame, likeness: Likeness) -> DataFrame:
    """Links (a, b) of set keys within each task of rows (task, lane, set_key, shingles,
    known)."""

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("set_key").to_pylist()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
        made = similar_sets(sets, likeness, table.column("lane").to_numpy(), table.column("known").to_pylist())
        return pa.table(
            {
                "a": pa.array([keys[a] for a, _ in made], type=pa.binary()),
                "b": pa.array([keys[b] for _, b in made], type=pa.binary()),
            }
        )

    return dealt.groupBy("task").applyInArrow(run, "a binary, b binary")


def _members(docs: DataFrame, text: str, keys: list[str], wanted: DataFrame, likeness: Likeness) -> DataFrame:
    """(set_key, root, shingles) of the wanted documents: their whole sets again."""
    texts = docs.select(*(F.col(k).alias(f"own_{k}") for k in keys), text)
    same = [texts[f"own_{k}"].eqNullSafe(wanted[k]) for k in keys]
    joined = texts.join(broadcast_within(wanted, MEMBER_BYTES), same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in text_chunks(batches, text, HASHED_CHARS):
            raw = [s.tobytes() for s in shingle_sets(found, likeness.words)]
            out = pa.RecordBatch.from_arrays(
                [batch.column("set_key"), batch.column("root"), pa.array(raw, type=pa.binary())],
                ["set_key", "root", "shingles"],
            )
            keys = batch.column("set_key").to_pylist()
            right = [xxhash.xxh3_128_digest(r) == k for r, k in zip(raw, keys, strict=True)]
            yield out.filter(pa.array(right, type=pa.bool_()))

    plain = joined.select("set_key", "root", text).mapInArrow(run, "set_key binary, root bigint, shingles binary")
    return plain.dropDuplicates(["set_key"])


def _blocks(members: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Members of groups (root, c) of two or more, with the group's number of blocks and
    their own block."""
    held = F.sum(F.octet_length("shingles"))
    sized = members.groupBy("root", "c").agg(F.count(F.lit(1)).alias("n"), held.alias("held"))
    grouped = sized.filter("n > 1").withColumn("blocks", F.ceil(F.col("held") / BLOCK_BYTES).cast("int"))
    joined = members.join(small_side(scratch.write(name, grouped)), ["root", "c"])
    block = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    return joined.withColumn("block", block).withColumn("known", F.lit(None).cast("binary"))


def _dealt(rows: DataFrame, root: Column, c: Column, i: Column, j: Column, lane: int) -> DataFrame:
    """Rows for _links(): their task and their side in it."""
    task = F.struct(root.alias("root"), c.alias("c"), i.alias("i"), j.alias("j"))
    return rows.select(task.alias("task"), F.lit(lane).alias("lane"), "set_key", "shingles", "known")


def _met_in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each set of a list of rows (sign, set_key, known, block) in order, the blocks that
    have a set of another group in that list. A list is held until it is whole."""

    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sign = rows.column("sign").to_numpy()
        group = rows.column("known").combine_chunks().dictionary_encode().indices.to_numpy()
        begins = np.flatnonzero(np.append(True, sign[1:] != sign[:-1]))
        mixed = np.minimum.reduceat(group, begins) != np.maximum.reduceat(group, begins)
        rows = rows.filter(pa.array(np.repeat(mixed, np.diff(np.append(begins, len(sign))))))
        if not rows.num_rows:
            return
        sign, block = rows.column("sign").to_numpy(), rows.column("block").to_numpy()
        group = rows.column("known").combine_chunks().dictionary_encode().indices.to_numpy()
        spots = np.flatnonzero(np.append(True, (sign[1:] != sign[:-1]) | (block[1:] != block[:-1])))
        least, most = np.minimum.reduceat(group, spots), np.maximum.reduceat(group, spots)
        first, last = np.searchsorted(sign[spots], sign), np.searchsorted(sign[spots], sign, side="right")
        sets = rows.select(["set_key", "known", "block"])
        for start in range(0, len(sign), LONG_LIST):
            a, count = first[start : start + LONG_LIST], (last - first)[start : start + LONG_LIST]
            own = start + np.repeat(np.arange(len(a)), count)
            spot = np.repeat(a - np.cumsum(count) + count, count) + np.arange(count.sum())
            apart = (least[spot] != group[own]) | (most[spot] != group[own])
            out = sets.take(pa.array(own[apart])).append_column("other", pa.array(block[spots][spot[apart]]))
            yield from out.group_by(out.column_names).aggregate([]).to_batches()

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, new]) if held is not None else new
        end = held.column("sign")[-1].as_py()
        if new.column("sign")[0].as_py() != end or len(held) == len(new):
            cut = int(np.searchsorted(held.column("sign").to_numpy(), end))
            if cut:
                yield from met(held.slice(0, cut))
                held = held.slice(cut)
    if held is not None:
        yield from met(held)


def _meetings(rest: DataFrame, likeness: Likeness, scratch: Scratch) -> DataFrame:
    """Rows for _links() of sets (set_key, shingles, known) that have a signature in common
    with a set of another group: a task for every two blocks with such sets, and of each
    block only those. Groups that are small share blocks."""
    sized = rest.groupBy("known").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("shingles")).alias("held"))
    sized = scratch.write("groups-left", sized)
    held = sized.filter(F.col("n") < HEAVY_COUNT).agg(F.sum("held")).first()[0] or 0
    shared = F.pmod(F.xxhash64("known"), F.lit(max(1, ceil(held / BLOCK_BYTES))))
    own = F.xxhash64("known", F.pmod(F.xxhash64("set_key"), F.ceil(F.col("held") / BLOCK_BYTES)))
    block = F.when(F.col("n") < HEAVY_COUNT, shared).otherwise(own).alias("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(s, dtype=np.uint64) for s in batch.column("shingles").to_pylist()]
            signs = signatures(sets, likeness)
            if sets:
                column = list_array(np.concatenate(signs).view(np.int64), [len(i) for i in signs])
                whole = [*(batch.column(c) for c in ("set_key", "known", "block")), column]
                yield pa.RecordBatch.from_arrays(whole, ["set_key", "known", "block", "signs"])

    placed = rest.join(small_side(sized), "known").select("set_key", "known", block, "shingles")
    signed = placed.mapInArrow(run, "set_key binary, known binary, block bigint, signs array<bigint>")
    listed = signed.select(F.explode("signs").alias("sign"), "set_key", "known", "block")
    listed = listed.repartition("sign").sortWithinPartitions("sign", "block")
    met = listed.mapInArrow(_met_in_lists, "set_key binary, known binary, block bigint, other bigint")
    met = met.repartition("set_key").distinct()
    task = F.struct(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    lane = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    joined = met.join(rest.select("set_key", "shingles"), "set_key")
    return joined.select(task.alias("task"), lane.alias("lane"), "set_key", "shingles", "known")


def small_side(df: DataFrame) -> DataFrame:
    """A side that is cheap to measure, broadcast if it takes MEMBER_BYTES at most."""
    return broadcast_within(df, MEMBER_BYTES)


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    likeness: Likeness = Likeness(),
    text: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """(id_column, n_shingles, component_id, component_key, text_hash) of every document.

    Two documents are linked when the Jaccard similarity of their shingle sets reaches
    the likeness. component_id is the least id that links lead to, the document's own
    included; component_key tells components apart where ids are null or repeat. A null
    text, an empty one or one without words has no shingles, no links, its own id and a
    null key. A null id never is the least unless all are null. Repeated rows and
    documents with equal sets are linked, also under one id. Other columns are ignored,
    whatever their names. No rows give no rows.

    Shingles are told apart by 64-bit hashes and sets by 128-bit ones.
    """
    bound_batches(docs.sparkSession)
    keyed = docs.select(F.col(id_column).alias("near_id"), F.col(text).alias("near_text")).withColumn(
        "near_hash", F.xxhash64("near_text")
    )
    keys, body = ["near_id", "near_hash"], "near_text"
    sets = scratch.write("sets", _sets(keyed, body, keys, likeness))
    filled = sets.filter("size > 0")
    kinds = filled.groupBy("set_key").agg(
        F.min("near_id").alias("least_id"), F.min(F.struct(*keys, "node")).alias("sample")
    )
    kinds = scratch.write("kinds", kinds.select("set_key", "least_id", "sample.*"))

    found = small_side(components(_candidates(filled, likeness), scratch, "candidates"))
    wanted = scratch.write("wanted", kinds.join(found, "node").select("set_key", *keys, "root"))
    members = scratch.write("members", _members(keyed, body, keys, wanted, likeness))
    members = members.withColumn("c", F.lit(0).cast("bigint"))
    divided = _blocks(members, scratch, "blocks")
    # A large component is divided by size classes first: other pairs cannot be similar.
    large = scratch.write("large", divided.filter("blocks > 1").select("set_key", "root", "shingles"))
    classes = likeness.size_classes(F.octet_length("shingles") / 8)
    large = _blocks(large.withColumn("c", F.explode(classes)), scratch, "class-blocks")
    small = divided.filter("blocks = 1")
    held = small.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0
    bundle = F.pmod(F.xxhash64("root"), F.lit(max(1, ceil(held / BLOCK_BYTES)))).cast("int")
    nothing = F.lit(None).cast("bigint")
    bundled = _dealt(small, nothing, nothing, bundle, F.lit(0), 2)
    # Every block of a large component by itself and with the first one.
    alone = _dealt(large, F.col("root"), F.col("c"), F.col("block"), F.col("block"), 2)
    heads = large.filter("block = 0 AND blocks > 1")
    heads = heads.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
    heads = _dealt(heads, F.col("root"), F.col("c"), F.lit(0), F.col("j"), 0)
    others = _dealt(large.filter("block > 0"), F.col("root"), F.col("c"), F.lit(0), F.col("block"), 1)
    links = scratch.write("links", _links(bundled.unionAll(alone).unionAll(heads).unionAll(others), likeness))
    labels = scratch.write("labels", components(links, scratch, "links-by-head"))

    # What is left of large components that these links do not connect.
    label = labels.select(F.col("node").alias("set_key"), F.col("root").alias("label"))
    known = large.filter("blocks > 2").drop("known").join(small_side(label), "set_key", "left")
    known = known.withColumn("known", F.coalesce("label", "set_key"))
    split = known.groupBy("root", "c").agg(F.min("known").alias("a"), F.max("known").alias("b")).filter("a <> b")
    rest = known.join(small_side(split.select("root", "c")), ["root", "c"], "left_semi")
    rest = scratch.write("rest", rest.select("set_key", "shingles", "known").dropDuplicates(["set_key"]))
    if not rest.isEmpty():
        more = scratch.write("more", _links(_meetings(rest, likeness, scratch), likeness))
        labels = scratch.write("all-labels", components(links.unionAll(more), scratch, "links-all"))

    # Sets with links to others get the least id of all; the rest keep their own.
    linked = scratch.write("linked", kinds.join(small_side(labels.withColumnRenamed("node", "set_key")), "set_key"))
    groups = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_linked = linked.join(small_side(groups), "root").select("set_key", "component_id", "root")
    named = kinds.join(small_side(of_linked), "set_key", "left")
    of_set = named.select(
        "set_key",
        F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("root", "set_key").alias("component_key"),
    )
    joined = sets.join(of_set, "set_key", "left")
    return joined.select(
        F.col("near_id").alias(id_column),
        F.col("size").cast("bigint").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("near_id")).alias("component_id"),
        "component_key",
        F.col("near_hash").alias("text_hash"),
    )


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share nine tenths of their three-word shingles."""
    found = near_duplicates(documents(spark, sf_dir), Scratch(spark, "near"), Likeness(3, 90, 100))
    return found.select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) >= 3
         THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
         WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM worded
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common >= 90 * (s.n + t.n - common)
),
neighbours AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reached.doc_id, neighbours.b FROM reached JOIN neighbours ON reached.other = neighbours.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

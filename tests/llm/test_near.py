"""Near duplicates against counting all pairs, with every path forced."""

import itertools
import random
import re
from collections import defaultdict

import pytest

from playmart.llm import near
from playmart.llm.components import components
from playmart.operators import Scratch


def plain(rows, words, share, of):
    sets = {}
    for i, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        runs = {tuple(w[j : j + words]) for j in range(len(w) - words + 1)}
        sets[i] = runs if len(w) >= words else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            lists[shingle].append(i)
    common = defaultdict(int)
    for members in lists.values():
        for pair in itertools.combinations(members, 2):
            common[pair] += 1
    for (a, b), n in common.items():
        if of * n >= share * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def grouped(spark, rows, likeness):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, size int")
    found = near.near_duplicates(docs, Scratch(spark, "t"), likeness).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


def family(draw, base, count, edits):
    out = []
    for _ in range(count):
        words = base.split()
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("words, share", [(3, 90), (5, 80)])
def test_every_path_finds_all_links(spark, monkeypatch, words, share):
    monkeypatch.setattr(near, "HEAVY_COUNT", 6)
    monkeypatch.setattr(near, "LONG_LIST", 5)
    monkeypatch.setattr(near, "BLOCK_BYTES", 2000)
    draw = random.Random(words)
    line = "a line that very many documents share with each other"
    texts = []
    for f in range(12):
        base = " ".join(f"v{draw.randrange(400)}" for _ in range(draw.choice([4, 20, 60, 150])))
        texts += family(draw, base + (f"\n{line}" if f % 2 else ""), draw.choice([2, 3, 30]), draw.choice([1, 3, 6]))
    texts += [line] * 3 + [f"{line} {i}" for i in range(20)] + ["", None, " \n", "one", "ONE", "one two", "Two one"]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    assert grouped(spark, rows, near.Likeness(words, share, 100)) == plain(rows, words, share, 100)


def test_two_large_unlinked_groups_that_share_shingles(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(near, "HEAVY_COUNT", 3)
    draw = random.Random(1)
    base = [f"v{i}" for i in range(100)]
    other = base[:85] + [f"u{i}" for i in range(15)]
    texts = family(draw, " ".join(base), 25, 1) + family(draw, " ".join(other), 25, 1)
    rows = list(enumerate(texts))
    for share in (70, 75, 80, 90):
        assert grouped(spark, rows, near.Likeness(3, share, 100)) == plain(rows, 3, share, 100)


def test_lists_that_run_over_batches():
    import numpy as np
    import pyarrow as pa

    draw = random.Random(6)
    shingles = sorted([5] * 300 + [draw.randrange(40) for _ in range(500)])
    nodes = [draw.randrange(150) for _ in shingles]
    rows = sorted(zip(shingles, nodes))
    likeness = near.Likeness()

    def edges(step):
        batches = []
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            columns = [pa.array([r[0] for r in part]), pa.array([r[1] for r in part]), pa.array([50] * len(part))]
            batches.append(pa.RecordBatch.from_arrays(columns, ["shingle", "node", "size"]))
        seen = defaultdict(int)
        for out in near._pairs_of_lists(iter(batches), likeness):
            for a, b, n in zip(*(out.column(i).to_pylist() for i in range(3))):
                seen[min(a, b), max(a, b)] += n
        return seen

    whole = edges(len(rows))
    by_shingle = defaultdict(set)
    for s, n in rows:
        by_shingle[s].add(n)
    for step in (1, 7, 64, 333):
        cut = edges(step)
        for members in by_shingle.values():
            for a, b in itertools.combinations(sorted(members), 2):
                if len(members) < near.LONG_LIST:
                    assert min(cut[a, b], 40) >= 1
                elif a == min(members):
                    assert cut[a, b] >= near.ENOUGH
        assert {p for p, n in cut.items() if n < near.ENOUGH} <= set(whole)
    assert np.all([n > 0 for n in whole.values()])


def test_odd_rows(spark):
    text = "the same words in all of these rows " * 3000
    rows = [(7, text), (7, text), (3, text + "x"), (None, text), (None, None), (9, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(near.near_duplicates(docs, Scratch(spark, "t")).collect(), key=str)
    ids = [(r.doc_id, r.component_id) for r in found if r.n_shingles]
    assert len(found) == 7 and len(ids) == 4 and {i for _, i in ids} <= {3, 7}
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found if not r.n_shingles) == [(0, 0), (0, 0), (9, 9)]
    assert near.near_duplicates(docs.limit(0), Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("edges_of_task", [1_000_000, 10])
def test_components(spark, monkeypatch, edges_of_task):
    from playmart.llm import components as module

    monkeypatch.setattr(module, "EDGES_OF_TASK", edges_of_task)
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (5, 5), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a int, b int"), Scratch(spark, "t"), "c").collect()}
    assert found == {**{i: 0 for i in [*range(41), 100]}, 200: 200, 201: 200}


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    expected = plain([(d.doc_id, d.text) for d in docs], 3, 90, 100)
    rows = near.op6_ngram_jaccard_join(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected


@pytest.mark.parametrize("share, of", [(90, 100), (80, 100), (1, 2), (19, 20)])
def test_similar_sets_share_signatures(share, of):
    import numpy as np

    likeness, draw, seen = near.Likeness(3, share, of), np.random.default_rng(share), 0
    for size in [1, 2, 4, 5, 8, 9, 10, 11, 19, 20, 50, 100, 101, 500, 1500] * 20:
        one = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
        gone = int(draw.integers(0, size * (of - share) // of + 2))
        new = draw.integers(0, 2**64, int(draw.integers(0, gone + 1)), dtype=np.uint64)
        other = np.unique(np.concatenate([draw.permutation(one)[gone:], new]))
        common = len(np.intersect1d(one, other))
        if len(new) + gone == 0 or not len(other) or not likeness.similar(common, len(one), len(other)):
            continue
        a, nothing, b = near.signatures([one, one[:0], other], likeness)
        assert not len(nothing)
        assert len(np.intersect1d(a, b)) >= likeness.parts(max(len(one), len(other)))[2]
        seen += 1
    assert seen > 20


def test_a_large_group_is_not_sent_to_every_block_again(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(near, "LONG_LIST", 5)
    sent, links = [], near._links
    monkeypatch.setattr(near, "_links", lambda dealt, likeness: (sent.append(dealt.count()), links(dealt, likeness))[1])
    draw = random.Random(3)
    base = [f"v{i}" for i in range(300)]
    odd = [" ".join(base[:267] + [f"u{i}.{j}" for j in range(33)]) for i in range(4)]
    rows = list(enumerate(family(draw, " ".join(base), 240, 1) + odd))
    assert grouped(spark, rows, near.Likeness(3, 90, 100)) == plain(rows, 3, 90, 100)
    assert len(sent) == 2 and 0 < sent[1] <= 4 * len(rows)


def test_lists_name_the_blocks_of_other_groups():
    import pyarrow as pa

    draw = random.Random(8)
    rows = sorted({(draw.randrange(30), draw.randrange(4), b"s%d" % draw.randrange(90)) for _ in range(900)})
    rows += [(40, 1, b"s1"), (40, 2, b"s11"), (50, 3, b"s5")]
    group = {s: b"g" + s[-1:] for _, _, s in rows}
    expected = {
        (s, group[s], b, c)
        for i, b, s in rows
        for j, c, t in rows
        if i == j and group[s] != group[t]
    }
    for step in (1, 7, 64, 5000):
        batches = []
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            columns = [[r[0] for r in part], [r[2] for r in part], [group[r[2]] for r in part], [r[1] for r in part]]
            kinds = pa.int64(), pa.binary(), pa.binary(), pa.int64()
            arrays = [pa.array(c, type=t) for c, t in zip(columns, kinds)]
            batches.append(pa.RecordBatch.from_arrays(arrays, ["sign", "set_key", "known", "block"]))
        found = [tuple(r.values()) for out in near._met_in_lists(iter(batches)) for r in out.to_pylist()]
        assert set(found) == expected

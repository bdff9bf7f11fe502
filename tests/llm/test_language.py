"""Language-model scores against plain counting, and the trie against a dictionary."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playmart.llm import language
from playmart.llm.language import ADDED, STRENGTH, op11_lm_scoring, pack, pack_grams, score, unpack, unpack_grams
from playmart.llm.trie import EliasFano, Trie, probabilities, quantise
from playmart.operators import Scratch

SF_DIR = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def plain(rows, order=3):
    """(n_tokens, n_known, N, base, model) of each row (key, text, trains)."""
    grams = [Counter() for _ in range(order + 1)]
    padded = [(["<"] * (order - 1) + tokens(text), trains) for _, text, trains in rows]
    for words, trains in padded:
        for i in range(order - 1, len(words)):
            for n in range(1, order + 1):
                grams[n][tuple(words[i - n + 1 : i + 1])] += bool(trains)
    known = Counter(dict(x for x in grams[1].items() if x[1]))
    total, contexts = sum(known.values()), [Counter() for _ in range(order + 1)]
    for n in range(2, order + 1):
        for gram, c in grams[n].items():
            contexts[n][gram[:-1]] += c
    found = []
    for words, _ in padded:
        base = model = seen = 0
        for i in range(order - 1, len(words)):
            c = known[(words[i],)]
            seen += c > 0
            p = (c + ADDED) / (total + ADDED * (len(known) + 1))
            base += math.log10(p)
            for n in range(2, order + 1):
                gram = tuple(words[i - n + 1 : i + 1])
                p = (grams[n][gram] + STRENGTH * p) / (contexts[n][gram[:-1]] + STRENGTH)
            model += math.log10(p)
        found.append((len(words) - order + 1, seen, total, base, model))
    return found


def same(found, expected):
    assert found[:3] == expected[:3]
    assert found[3] == pytest.approx(expected[3], rel=1e-9)
    # A code rounds a probability by half a step of 1 / 4096 decades.
    assert found[4] == pytest.approx(expected[4], abs=1.3e-4 * found[0])


def held(key):
    return zlib.crc32(str(key).encode()) % 10 == 0


def test_the_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    expected = dict(zip([d for d, _ in docs], plain([(d, t, not held(d)) for d, t in docs]), strict=True))
    rows = op11_lm_scoring(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(expected)
    for r in rows:
        same((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score), expected[r.doc_id])
        assert r.held_out == held(r.doc_id)
    apart = [r for r in rows if r.held_out]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart)


ODD = [
    (1, "The cat sat.\tTHE cat\x0bSAT.", True),
    (2, None, True),
    (3, "", None),
    (4, "the cat ran  ", False),
    (4, "the cat ran", True),
    (None, "Ünï CÖDE \xa0 the", True),
    (5, "word " * 30_000, True),
    (6, "\n \r", True),
    (7, "a b " * 500 + "x" * 50_000, True),
]


@pytest.mark.parametrize("order, chars, shard", [(3, 1, 10), (3, 10**6, 10**6), (2, 100, 1000), (4, 200, 1000)])
def test_odd_rows(spark, order, chars, shard):
    docs = spark.createDataFrame(ODD, "doc_id int, text string, train boolean").repartition(3)
    for name in ("score", "chunk", "key", "answer"):
        docs = docs.withColumn(name, F.lit("own"))
    rows = score(docs, F.col("train"), Scratch(spark, "language"), "doc_id", order, chars, shard).collect()
    expected = sorted(zip([k for k, _, _ in ODD], plain(ODD, order), strict=True), key=repr)
    found = sorted(((r.doc_id, tuple(r)[1:]) for r in rows), key=repr)
    assert [k for k, _ in found] == [k for k, _ in expected]
    for key in {k for k, _ in found}:
        a, b = (sorted(v for k, v in x if k == key) for x in (found, expected))
        for x, y in zip(a, b, strict=True):
            same(x, y)


def test_an_empty_table_and_no_training(spark):
    docs = spark.createDataFrame(ODD, "doc_id int, text string, train boolean")
    assert score(docs.limit(0), F.lit(True), Scratch(spark, "language")).count() == 0
    for r in score(docs, F.lit(False), Scratch(spark, "language")).collect():
        assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score == pytest.approx(0)


def test_frequent_contexts_spread(monkeypatch):
    """The codes do not depend on how n-grams are dealt out."""
    schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()), ("grams", pa.binary())])
    answer = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()), ("answer", pa.binary())])
    pick = np.random.default_rng(5)
    ids = np.unique(pick.integers(1, 10**6, 40))
    drawn = np.minimum(pick.zipf(1.5, (2, 600)) - 1, len(ids) - 2)
    drawn[:, [299, 599]] = len(ids) - 1  # what ends a text
    counts = np.bincount(drawn.ravel(), minlength=len(ids))

    def codes(limit):
        monkeypatch.setattr(language, "FREQUENT", limit)
        rows = []
        for number, own in enumerate(drawn):
            row = {"chunk": number, "sizes": [300, 300], "trains": [True, True], "tokens": pack(own), "ids": pack(np.diff(ids, prepend=0)), "counts": pack(counts)}
            rows.append(language.Chunk(row, 4, 3))
        found = [{}, {}]
        for n in (2, 3):
            blobs = [b for c, f in zip(rows, found, strict=True) for b in language._gram_shards(c, n, f, 7)]
            shards = [[b for b in blobs if b["shard"] == s] for s in range(7)]
            answers = [language._answer(pa.Table.from_pylist(b, schema), answer) for b in shards if b]
            every = pa.concat_tables(answers)
            for c, f in zip(rows, found, strict=True):
                own = every.filter(pc.equal(every.column("chunk"), c.number))
                f[n] = language._codes(c, own, f, n, 7)
        return found

    together, apart = codes(10**9), codes(20)
    for a, b in zip(together, apart, strict=True):
        assert (a[2] == b[2]).all() and (np.abs(a[3] - b[3]) <= 1).all()


rising = st.lists(st.integers(0, 1 << 40), max_size=60).map(sorted)


@settings(max_examples=200, deadline=None)
@given(rising, st.lists(st.integers(0, 1 << 41), max_size=30))
def test_elias_fano(values, asked):
    sequence = EliasFano(np.array(values, dtype=np.int64))
    assert sequence.get(np.arange(len(values))).tolist() == values
    asked = np.array(asked + values, dtype=np.int64)
    places, equal = sequence.successors(asked.astype(np.uint64))
    assert places.tolist() == np.searchsorted(np.array(values, dtype=np.int64), asked).tolist()
    assert equal.tolist() == [a in set(values) for a in asked.tolist()]


grams = st.sets(st.tuples(*[st.integers(0, 9) | st.integers(0, 1 << 33)] * 3), min_size=1, max_size=80).map(sorted)


@settings(max_examples=200, deadline=None)
@given(grams, st.randoms())
def test_trie_and_packing(rows, pick):
    columns = [np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)]
    keep = np.array([pick.random() < 0.7 for _ in rows])
    codes = np.array([pick.randrange(1, 1 << 16) for _ in rows], dtype=np.uint16)
    trie = Trie([c[keep] for c in columns], codes[keep])
    assert trie.find(columns).tolist() == np.where(keep, codes, 0).tolist()
    again, counts, totals = unpack_grams(pack_grams(columns, codes, codes[:3]))
    assert [c.tolist() for c in again] == [c.tolist() for c in columns]
    assert counts.tolist() == codes.tolist() and totals.tolist() == codes[:3].tolist()


def test_codes():
    shares = np.array([1.0, 0.5, 1e-9, 1e-15])
    assert probabilities(quantise(shares)) == pytest.approx(shares, rel=3e-4)
    assert probabilities(np.array([0])) == [0] and unpack(pack(np.zeros(0, dtype=int))).tolist() == []

"""Toxicity by held-out labels and by disguised insults."""

import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from playmart.llm import toxicity

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    rows = toxicity.op4_toxicity(spark, SF_DIR).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))


def test_held_out_documents(scored):
    rows, labels = scored
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, other = (np.array([s for t, s, _ in held if t == x]) for x in (1, 0))
    ranks = np.mean([(s > other).mean() + (s == other).mean() / 2 for s in toxic])
    assert ranks >= 0.94
    assert np.mean([p == t for t, _, p in held]) >= 0.96
    assert np.mean([p for t, _, p in held if t == 0]) <= 0.02


def test_disguised_insults_are_nearer_than_other_words(model):
    plain = model.margins(["harbour", "window", "thshre", "onblean", "a", ""])
    for insult in ("idiot", "moron", "pathetic", "disgusting"):
        forms = [insult, insult.upper().lower() + "!!", "-".join(insult), insult[:2] + "x" + insult[2:], insult[:3] + "*" + insult[3:]]
        assert model.margins(forms).min() > plain.max()
    assert "idiot" in toxicity.words_of("such an i d i o t here")


def test_odd_rows(spark, model):
    rows = [(1, "you idiot", 0.5), (1, "you idiot", 0.5), (2, None, None), (3, "", 0.0), (4, "fine words " * 50_000, 1.0), (5, "x" * 100_000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxicity double")
    found = {(r.doc_id, r.text and r.text[:9]): r.toxicity for r in toxicity.score(docs, model).collect()}
    assert found[1, "you idiot"] > 0.5 > found[2, None] == found[3, ""]
    assert found[4, "fine word"] < 0.5
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_without_labels_the_score_is_constant(spark):
    docs = spark.createDataFrame([(i, f"words {i}") for i in range(20)], "doc_id bigint, text string")
    for labels in ([], [(i, 0) for i in range(20)], [(i, None) for i in range(20)], [(i, 1) for i in range(20)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        values = {r.toxicity for r in toxicity.score(docs, model).collect()}
        assert len(values) == 1 and 0 < values.pop() < 1


def test_the_held_out_fold_and_contradictions_do_not_teach(spark):
    docs = spark.createDataFrame([(i, "awful" if i % 2 else f"word{i}") for i in range(400)], "doc_id bigint, text string")
    held = [(i, i % 2) for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    both = [(i, x) for i in range(400) for x in (0, 1)]
    for labels in (held, both):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert model.curve[:3] == (0.0, 0.0, 0.0)


def test_one_row_of_each_id_trains_and_the_driver_gets_the_model(spark, monkeypatch):
    texts = [(0, f"poor thing number {i}") for i in range(50)] + [(i, f"text {i}") for i in range(1, 20)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, toxic int")
    monkeypatch.setattr(toxicity, "held_out", lambda c: c < 0)
    rows = {r.doc_id: r.text for r in toxicity.training_rows(docs, labels).collect()}
    # The text of the repeated id that counted before.
    assert len(rows) == 20 and rows[0] == "poor thing number 9"
    collected = []
    plain = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: collected.append(plain(df)) or collected[-1])
    toxicity.fit(docs, labels)
    assert [[r.asDict().keys() for r in rows] for rows in collected] == [[{"weights", "bias", "curve"}]]


def test_words_beyond_the_cache_score_alike(spark, monkeypatch):
    draw = np.random.default_rng(3)
    model = toxicity.Model(draw.normal(size=toxicity.CODES**3).astype(np.float32), 0.1, (1.0, 0.5, -0.2, 0.1))
    texts = [" ".join(f"w{i % 7}ord{j}" for j in range(i)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 5)
    assert {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()} == whole


def test_kernel_against_all_triples():
    """The kernel of two words, by enumeration of their ordered triples of letters."""
    def plain(word):
        """(weights of its triples, norm); the norm counts equal triples apart."""
        weights, norm = Counter(), 0
        for places in combinations(range(len(word)), 3):
            span = places[2] - places[0] + 1
            if span <= toxicity.MAX_SPAN:
                weights["".join(word[p] for p in places)] += toxicity.DECAY**span
                norm += toxicity.DECAY ** (2 * span)
        return weights, norm**0.5

    words = ["idiot", "idxiot", "stupid", "window", "aaaaa", "banana", "abcdefgh", "toidi"]
    features = [plain(w) for w in words]
    expected = [[sum(v * g[t] for t, v in f.items()) / (m * n) for g, n in features] for f, m in features]
    assert np.allclose(toxicity._kernel(words, words), expected, atol=1e-4)

"""Tokens against the public library; packing under every constraint."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from playmart.llm import packing
from playmart.llm.common import public_file
from playmart.operators import Scratch


@pytest.fixture(scope="module")
def vocabulary():
    return public_file(packing.VOCABULARY)


@pytest.fixture(scope="module")
def library(vocabulary):
    tokenizer = Tokenizer.from_buffer(vocabulary)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_ids_are_those_of_the_library(vocabulary, library):
    alphabet = "ab's'stmdrvel1２ \n\t  \x85\x1c!?é'’ ́𝒳ⅷΣσİß가..,&%ABC|<>endoftext\0"
    draw = random.Random(5)
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(4000)]
    texts += ["", " ", "<|endoftext|>", "a" * 5000, "It's they'll we've.", "Ünïcode wörds, ..."]
    ids, sizes = packing.WordIds(vocabulary).encode(texts)
    for own, text in zip(np.split(ids, np.cumsum(sizes)[:-1]), texts, strict=True):
        assert own.tolist() == library.encode(text, add_special_tokens=False).ids


def test_few_words_at_a_time_and_little_memory_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(packing, "ASKED_WORDS", 3)
    words = packing.WordIds(vocabulary, cached_words=5)
    texts = [f"one{i} two three{i}, four! fivesix Seven{i}th" for i in range(40)]
    for _ in range(2):
        ids, sizes = words.encode(texts)
        assert len(words.known) <= 5
        for own, text in zip(np.split(ids, np.cumsum(sizes)[:-1]), texts, strict=True):
            assert own.tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_are_remembered_without_the_marks_behind_them(vocabulary, library):
    words = packing.WordIds(vocabulary)
    text = "One one, ONE. one! it's, é, x1, ..."
    assert words.encode([text, "", text])[0].tolist() == 2 * library.encode(text, add_special_tokens=False).ids
    assert {w for w in words.known if w.startswith(b"one")} == {b"one"}
    assert words.encode(["", " \n"])[1].tolist() == [0, 0]


def test_distinct_words_give_the_text_in_order():
    draw = random.Random(6)
    for _ in range(300):
        text = "".join(draw.choice("ab1,.'é \n\x85𝒳") for _ in range(draw.randrange(40)))
        words, place, starts = packing.distinct_words(text.encode())
        expected = []
        for word in text.encode().split():
            stem = word.rstrip(packing.PUNCTUATION)
            expected += [w for w in ((stem, word[len(stem) :]) if stem[-1:].isalpha() else (word,)) if w]
        assert len(set(words)) == len(words) and [words[p] for p in place] == expected
        assert all(text.encode()[s:].startswith(w) for s, w in zip(starts, expected, strict=True))


def test_full_memory_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 4)
    words = packing.WordIds(vocabulary)
    for text in ["one two. three, four! five", "five six! one seven. two"] * 2:
        assert words.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [packing.Capacity(100, 100, 10_000), packing.Capacity(100, 3, 4_500)])
def test_bins_hold_every_constraint(rule, capacity):
    draw = random.Random(1)
    lengths = np.array([draw.randrange(1, 60) for _ in range(500)])
    bins, offsets = packing.best_fit(lengths, capacity, rule)
    for b in set(bins.tolist()):
        own = np.flatnonzero(bins == b)
        assert lengths[own].sum() <= capacity.tokens and len(own) <= capacity.documents
        assert (lengths[own] ** 2).sum() <= capacity.attention
        ordered = own[np.argsort(offsets[own])]
        assert offsets[ordered].tolist() == [0, *np.cumsum(lengths[ordered])[:-1].tolist()]


def test_few_bins():
    draw = random.Random(2)
    lengths = np.array([draw.randrange(1, 4097) for _ in range(200)] + [draw.randrange(1, 400) for _ in range(3000)])
    bins, _ = packing.best_fit(lengths, packing.Capacity())
    assert bins.max() + 1 <= 1.01 * lengths.sum() / 4096 + 1


def test_too_long_a_piece_raises():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([5000]), packing.Capacity())
    assert packing.best_fit(np.array([], dtype=np.int64), packing.Capacity())[0].tolist() == []


def check(rows, texts, library):
    """Every piece is there once; sequences are gapless and within 4096 tokens."""
    expected = []
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for n, start in enumerate(range(0, len(ids), 4096)):
            cut = ids[start : start + 4096]
            expected.append((doc_id, n, start, len(cut), zlib.crc32(np.array(cut, dtype="<u4").tobytes())))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(expected, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by)


def test_operator_on_odd_rows(spark, vocabulary, library):
    long = "many words here " * 6000
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (3, "", ""), (4, long, "y"), (5, long, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, offset string")
    scratch = Scratch(spark, "test")
    pieces = packing.token_pieces(docs, vocabulary, with_ids=True)
    found = packing.pack(pieces, scratch).collect()
    check(found, [r[:2] for r in rows], library)
    assert all(len(r.ids) == r.length for r in found)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_equal_lengths_are_spread_over_groups(spark, vocabulary):
    docs = spark.range(2000).selectExpr("0L AS doc_id", "'the same words again' AS text")
    pieces = packing.token_pieces(docs, vocabulary)
    found = packing.pack(pieces, Scratch(spark, "test"), group_sequences=1).collect()
    groups = {r.sequence_id >> packing.BIN_BITS for r in found}
    assert len(found) == 2000 and len(groups) >= 2


def test_query(spark, library):
    rows = packing.op10_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    used = check(rows, [(d.doc_id, d.text) for d in docs], library)
    assert used <= sum(r.length for r in rows) / 4096 + 2

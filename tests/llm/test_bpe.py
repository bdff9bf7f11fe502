"""Byte-level BPE against the regular expression and the public library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from playmart.llm import bpe
from playmart.llm.common import public_file

ALPHABET = "ab's'stmdrvel1２ \n\t  \x85\x1c!?é'’ ́𝒳ⅷΣ가|<>\0"


@pytest.fixture(scope="module")
def raw():
    return public_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def known(raw):
    return bpe.PieceIds(bpe.parse_ranks(raw))


@pytest.fixture(scope="module")
def library(raw):
    ranks = bpe.parse_ranks(raw)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(count=3000):
    draw = random.Random(7)
    made = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(60))) for _ in range(count)]
    return [*made, "", " ", "'", "'s", "x'll y", "''s", "\0 \0a", "<|endoftext|>", "a" * 3000, "ab" * 2000, "\n" * 500]


def test_pieces_are_those_of_the_pattern():
    given = texts()
    raw, starts, ends, cuts = bpe.piece_bounds(given)
    whole = raw.tobytes()
    for i, text in enumerate(given):
        own = [whole[s:e].decode() for s, e in zip(starts[cuts[i] : cuts[i + 1]], ends[cuts[i] : cuts[i + 1]])]
        assert own == regex.findall(public_tokenizers.PATTERN, text)


def test_ids_are_those_of_the_library(known, library):
    given = texts()
    ids, sizes = known.encode(given)
    for own, text in zip(np.split(ids, np.cumsum(sizes)[:-1]), given, strict=True):
        assert own.tolist() == library.encode_ordinary(text)


def test_side_by_side_merging_equals_the_heap(known):
    draw = random.Random(3)
    pieces = [bytes(draw.choice(b"theaion \xc3\xa9") for _ in range(draw.randrange(1, 40))) for _ in range(2000)]
    alone = [np.array(bpe.merge(p, known.ranks), dtype="<u4").tobytes() for p in pieces]
    assert known.merge_all(pieces) == alone


def test_full_memory_changes_nothing(known, raw, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 5)
    small = bpe.PieceIds(bpe.parse_ranks(raw))
    for text in ["one two three four five six seven eight", "eight nine ten one two"] * 2:
        assert small.encode([text])[0].tolist() == library.encode_ordinary(text)
    assert len(small.known) <= 5


def test_operator_on_odd_rows(spark, raw, library):
    long = "very long " * 30_000
    rows = [(1, "It's  a\ntest", 5), (1, "It's  a\ntest", 5), (None, None, None), (3, "", 0), (4, long, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    found = bpe.decode(bpe.encode(docs, raw), raw).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode()) for r in found) == sorted((i or 0, t or "") for i, t, _ in rows)
    for row in found:
        text = bytes(row.decoded)
        assert row.ids == library.encode_ordinary(text.decode())
        words = [text[a:b] for a, b in zip([0, *row.ends], row.ends)]
        assert b"".join(words) == text and len(row.ends) == len(row.ids)
    assert bpe.encode(docs.limit(0), raw).count() == 0


def test_query(spark, library):
    got = {r.doc_id: r for r in bpe.op1_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode_ordinary(doc.text)
        assert got[doc.doc_id].n_tokens == len(ids)
        assert got[doc.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[doc.doc_id].decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()

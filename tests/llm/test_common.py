"""Helpers of the operators, and what they leave in a worker's memory."""

import numpy as np
import pyarrow as pa

from playmart.llm import common


def test_powers_of_any_count_and_few_kept(monkeypatch):
    monkeypatch.setattr(common, "_POWERS", {})
    monkeypatch.setattr(common, "KEPT_POWERS", 100)
    for count in (1, 50, 99, 100, 101, 250, 300, 1000, 10):
        expected = [pow(common.MULTIPLIER, i, 1 << 64) for i in range(count)]
        assert common._powers(common.MULTIPLIER, count).tolist() == expected
    assert max(len(p) for p in common._POWERS.values()) == 100


def test_equal_slices_of_long_texts(monkeypatch):
    words = [f"w{i % 13}".encode() for i in range(500)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    raw = np.frombuffer(b" ".join(words), dtype=np.uint8)
    plain = [x.tolist() for x in common.equal_slices(raw, starts, ends)]
    monkeypatch.setattr(common, "_POWERS", {})
    monkeypatch.setattr(common, "KEPT_POWERS", 64)
    assert [x.tolist() for x in common.equal_slices(raw, starts, ends)] == plain
    assert [words[plain[0][p]] for p in plain[1]] == words


def test_chunks_hold_all_texts_and_unused_memory_goes_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda real=common.give_back: given.append(real()))
    texts = ["a" * 5, None, "", "b" * 30, "c", "d" * 4, "e"]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, type=pa.string())], ["text"]) for t in (texts[:4], [], texts[4:])]
    chunks = common.text_chunks(iter(batches), "text", 6)
    found = [(b.num_rows, t) for b, t in chunks]
    assert [x for _, t in found for x in t] == [t or "" for t in texts]
    assert all(n == len(t) and (n == 1 or len("".join(t)) <= 6) for n, t in found)
    assert len(given) == 1

"""Conversation repair against a plain search over all edits."""

import random
import sys
import zlib
from functools import cache
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playmart.llm import audits
from playmart.llm.conversations import WHITE, damage, op13_conversation_repair, repair
from playmart.operators import Scratch

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
sys.setrecursionlimit(20_000)  # the search below goes as deep as a conversation is long
NAMES = {"u": "user", "a": "assistant"}
FORWARD = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}


def plain_damage(rows):
    after = {}
    for conv, turn, role, text in rows:
        after.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if kind == 4:
            role = "user"
        after[conv] += [(turn, role, text)] * (kind != 0) * (1 + (kind == 3))
    return after


def cheapest(rows):
    """(cost, audit, repaired) for rows (role, text, drop, truncated)."""

    @cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in "EA":
            found.append((0, ""))
        steps = [("I", i, name, 2) for name in "ua"] if inserts < 3 else []
        if i < len(rows):
            role, _, drop, truncated = rows[i]
            steps.append(("D", i + 1, None, 3))
            if not drop:
                steps.append(("K", i + 1, role[:1], truncated))
                steps += [("R", i + 1, name, 2 + truncated) for name in "ua"]
        for edit, j, initial, cost in steps:
            end = state if not initial else FORWARD.get((state, initial))
            rest = end and best(j, end, inserts + 1 if edit == "I" else 0)
            if rest:
                found.append((cost + rest[0], edit + rest[1]))
        return min(found, default=None)

    cost, audit = best(0, "E", 0)
    turns, state, queue = [], "E", iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(queue)
        if edit == "D":
            continue
        initial = row[0][:1] if edit == "K" else "a" if state == "U" else "u"
        turns.append((row[0] if edit == "K" else NAMES[initial], "" if row is None else row[1]))
        state = FORWARD[state, initial] if initial else state
    return cost, audit, turns


def plain(after):
    found = {}
    for conv, rows in after.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, judged, faults = set(), [], []
        for _, role, text in rows:
            body = text.rstrip(WHITE)
            fault = "blank" if not body else "dup" if (role, text) in seen else "cut" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            judged.append((role, text, fault in ("blank", "dup"), int(fault == "cut")))
        illegal = sum(x[0][:1] + y[0][:1] not in ("su", "ua", "au") for x, y in zip(judged, judged[1:], strict=False))
        cost, audit, repaired = cheapest(judged)
        digest = sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        found[conv] = (gaps, faults.count("blank"), faults.count("dup"), faults.count("cut"), illegal, cost, audit, digest)
    return found


def collected(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_the_whole_table(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op13_conversation_repair(spark, SF_DIR)) == plain(plain_damage(given))


def odd_rows():
    pick = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "cut", "", " \t", "Why?\n", None, "long " * 5000 + "end."]
    rows = [(c, pick.choice([None, *range(9)]), pick.choice(roles), pick.choice(texts)) for c in range(40) for _ in range(pick.randrange(1, 9))]
    rows += [(None, t, "user", "Hi.") for t in range(5)] + [(50, 1, "user", "Same.")] * 400
    return rows + [(99, t, pick.choice(roles[:3]), f"Text {t % 250}" + pick.choice([".", ""])) for t in range(-100, 500)]


@pytest.mark.parametrize("piece_rows", [1, 7, 1024])
def test_odd_rows_and_long_conversations(spark, piece_rows):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("place", "copies", "first", "gone", "conv_key"):
        docs = docs.withColumn(name, F.lit("own"))
    found, pieces = repair(damage(docs), Scratch(spark, "conversations"), piece_rows)
    expected = plain(plain_damage(rows))
    assert collected(found) == expected
    turns = {}
    for r in sorted(pieces.collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).extend(f"{t.role}:{t.text}" for t in r.repaired)
    assert {c: sha256("\n".join(turns.get(c, [])).encode()).hexdigest() for c in expected} == {c: e[-1] for c, e in expected.items()}


def test_an_empty_table_and_a_dropped_conversation(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collected(repair(damage(empty), Scratch(spark, "conversations"))[0]) == {}
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    nothing = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert collected(repair(damage(one), Scratch(spark, "conversations"))[0]) == {gone: nothing}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.booleans(), st.booleans()), max_size=14), st.integers(0, 14))
def test_the_program_finds_the_least_audit(kinds, cut):
    rows = [audits.Row(role, "x", 1, drop, truncated and not drop) for role, drop, truncated in kinds]
    expected = cheapest(tuple((r.role, r.text, r.drop, int(r.truncated)) for r in rows))
    best = audits.final(audits.run(rows, audits.EMPTY))
    audit = audits.text(best.node)
    assert (best.cost, audit, audits.apply(rows, audit, audits.EMPTY)) == expected
    joined = audits.Node(None, "")
    states = {audits.EMPTY: audits.Best(0, joined)}
    for part in filter(None, (rows[:cut], rows[cut:])):
        after = {}
        for entry, (cost, node) in states.items():
            for state, option in audits.run(part, entry).items():
                audits.offer(after, state, cost + option.cost, node, audits.text(option.node), entry)
        states = after
    assert audits.text(audits.final(states).node) == audit


def test_colliding_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(audits, "MODULUS", 3)
    root = audits.Node(None, "")

    def chain(string):
        node = root
        for letter in string:
            node = audits.Node(node, letter)
        return node

    pick = random.Random(3)
    for _ in range(500):
        a, b = ("".join(pick.choice("DIKR") for _ in range(pick.randrange(12))) for _ in range(2))
        assert audits.less(chain(a), chain(b)) == (a < b)

"""Cheapest edits of a run of turns: a dynamic program over persistent audits.

The role initials of a conversation must read ``(s?(ua)+)?``. The automaton of that
pattern has four states, and after each row the program keeps one audit per state: the
least cost and, of equal ones, the ASCII-least string of edit initials. Audits are linked
nodes that share their prefixes. A node knows its ancestors at the distances of powers of
two and the rolling hash of its whole string, so two audits of one cost are compared by a
search for their longest common prefix. Equal hashes are verified on the letters.

A run may begin in any state, as it may be a part of a longer conversation: the audits of
its parts are joined by the same program, with a part's audit as the label of a node.
"""

from __future__ import annotations

from typing import NamedTuple

EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
FINAL = (EMPTY, ASSISTANT)
#: Where a kept row of a role's initial leads to.
MOVES = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
BASE, MODULUS = 1_000_003, (1 << 61) - 1


class Node:
    """The end of an audit: its parent's audit and then ``label``."""

    __slots__ = ("entry", "hash", "label", "length", "parent", "ups")

    def __init__(self, parent: Node | None, label: str, entry: int = EMPTY):
        self.parent, self.label, self.entry = parent, label, entry
        if parent is None:
            self.length, self.hash, self.ups = 0, 0, []
            return
        self.length = parent.length + len(label)
        self.hash = extended(parent.hash, label)
        ups, up, k = [parent], parent, 0
        while k < len(up.ups):
            up = up.ups[k]
            ups.append(up)
            k += 1
        self.ups = ups


def extended(value: int, label: str) -> int:
    """The rolling hash of a string of hash ``value`` followed by ``label``."""
    for letter in label:
        value = (value * BASE + ord(letter)) % MODULUS
    return value


def holder(node: Node, length: int) -> Node:
    """The first node on the way to ``node`` whose audit has so many letters at least."""
    for k in reversed(range(len(node.ups))):
        if k < len(node.ups) and node.ups[k].length >= length:
            node = node.ups[k]
    return node


def prefix_hash(node: Node, length: int) -> int:
    if not length:
        return 0
    end = holder(node, length)
    return extended(end.parent.hash, end.label[: length - end.parent.length])


def letter(node: Node, place: int) -> str:
    end = holder(node, place + 1)
    return end.label[place - end.parent.length]


def tails(a: Node, b: Node) -> tuple[str, str]:
    """What follows the last node that both audits share."""
    left, right = [], []
    while a is not b:
        if a.length >= b.length and a.parent is not None:
            left.append(a.label)
            a = a.parent
        else:
            right.append(b.label)
            b = b.parent
    return "".join(reversed(left)), "".join(reversed(right))


def less(a: Node, b: Node) -> bool:
    """Whether the audit of ``a`` is ASCII-less than that of ``b``."""
    low, high = 0, min(a.length, b.length)
    while low < high:
        middle = (low + high + 1) // 2
        if prefix_hash(a, middle) == prefix_hash(b, middle):
            low = middle
        else:
            high = middle - 1
    left, right = tails(a, b)
    shared = a.length - len(left)
    if low < shared or left[: low - shared] != right[: low - shared]:  # a collision of hashes
        return left < right
    if low == min(a.length, b.length):
        return a.length < b.length
    return letter(a, low) < letter(b, low)


class Best(NamedTuple):
    cost: int
    node: Node


Audits = dict[int, Best]


def offer(audits: Audits, state: int, cost: int, parent: Node, label: str, entry: int = EMPTY) -> None:
    """Let ``parent`` followed by ``label`` be the audit of a state, if it is better."""
    held = audits.get(state)
    if held is not None and held.cost < cost:
        return
    node = Node(parent, label, entry)
    if held is None or cost < held.cost or less(node, held.node):
        audits[state] = Best(cost, node)


def insert(audits: Audits) -> Audits:
    """The audits with turns inserted at their ends: two at most, as three lead back."""
    for begin, end in ((EMPTY, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
        if begin in audits:
            cost, node = audits[begin]
            offer(audits, end, cost + INSERT_COST, node, "I")
    return audits


class Row(NamedTuple):
    """A turn that occurs ``copies`` times in a row. The first may stay, unless ``drop``."""

    role: str
    text: str
    copies: int
    drop: bool
    truncated: bool


def advance(audits: Audits, row: Row) -> Audits:
    insert(audits)
    after: Audits = {}
    penalty = TRUNCATED_COST if row.truncated else 0
    initial, repeats = row.role[:1], "D" * (row.copies - 1)
    spent = DELETE_COST * (row.copies - 1)
    for state, (cost, node) in audits.items():
        offer(after, state, cost + DELETE_COST + spent, node, "D" + repeats)
        if row.drop:
            continue
        kept = MOVES.get(initial, {}).get(state) if initial else state
        if kept is not None:
            offer(after, kept, cost + penalty + spent, node, "K" + repeats)
        offer(after, NEXT[state], cost + REROLE_COST + penalty + spent, node, "R" + repeats)
    return after


def run(rows: list[Row], entry: int) -> Audits:
    """The audits of rows that follow a conversation in state ``entry``."""
    audits = {entry: Best(0, Node(None, ""))}
    for row in rows:
        audits = advance(audits, row)
    return audits


def final(audits: Audits) -> Best:
    """The best audit that ends the pattern."""
    insert(audits)
    done: Audits = {}
    for state in FINAL:
        if state in audits:
            cost, node = audits[state]
            offer(done, EMPTY, cost, node, "")
    return done[EMPTY]


def labels(node: Node) -> list[tuple[int, str]]:
    """The labels of an audit with the states in which they begin, in order."""
    found = []
    while node.parent is not None:
        found.append((node.entry, node.label))
        node = node.parent
    return found[::-1]


def text(node: Node) -> str:
    return "".join(label for _, label in labels(node))


def apply(rows: list[Row], audit: str, state: int) -> list[tuple[str, str]]:
    """The repaired turns (role, text) of rows under an audit that begins in ``state``."""
    turns: list[tuple[str, str]] = []
    queue = iter([row for row in rows for _ in range(row.copies)])
    for edit in audit:
        if edit == "D":
            next(queue)
            continue
        row = None if edit == "I" else next(queue)
        if edit == "K":
            turns.append((row.role, row.text))
            state = MOVES[row.role[0]][state] if row.role else state
        else:
            state = NEXT[state]
            turns.append((NAMES[state], "" if row is None else row.text))
    return turns

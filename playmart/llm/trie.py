"""A compact trie of n-grams: Elias-Fano levels in a memory map.

A level holds the children of all nodes of the level above, by node and then by word. The
word ids of a node's children are raised by the last value before them, so a whole level
rises and is stored as one Elias-Fano sequence, as are the pointers to the places where the
children of each node begin. A word is looked for relative to its context: its id, raised by
the value before the context's children, has its successor in the level either among those
children, equal to it, or it does not occur after the context.

The nodes of the last level have a quantised probability. All look-ups take arrays. The
arrays of a trie lie in one anonymous memory map outside the heap of Python.
"""

from __future__ import annotations

import mmap

import numpy as np

#: Steps of a quantised probability in a decade, and the largest code. Code 0 says that
#: an n-gram is missing.
STEPS, MOST = 4096, (1 << 16) - 1
BLOCK = 64  # bits of a block of the directory, a word

ONES = np.uint64(0x0101010101010101)
TOPS = np.uint64(0x8080808080808080)
_PLACES = np.zeros((256, 8), dtype=np.uint8)  # place of the k-th set bit of a byte
for _byte in range(256):
    _set = [b for b in range(8) if _byte >> b & 1]
    _PLACES[_byte, : len(_set)] = _set


def quantise(probabilities: np.ndarray) -> np.ndarray:
    """Codes of probabilities above 0: their logarithm in steps, and 1."""
    return (np.clip(np.rint(-np.log10(probabilities) * STEPS), 0, MOST - 1) + 1).astype(np.uint16)


def probabilities(codes: np.ndarray) -> np.ndarray:
    """The probabilities of codes; 0 for a missing n-gram."""
    return np.where(codes > 0, 10.0 ** ((1.0 - codes.astype(np.float64)) / STEPS), 0.0)


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The same arrays in one anonymous memory map."""
    starts = np.cumsum([0, *[-(-a.nbytes // 8) * 8 for a in arrays]])
    memory = mmap.mmap(-1, max(8, int(starts[-1])))
    found = []
    for array, start in zip(arrays, starts[:-1].tolist(), strict=True):
        view = np.frombuffer(memory, dtype=array.dtype, count=array.size, offset=start).reshape(array.shape)
        view[...] = array
        found.append(view)
    return found


class EliasFano:
    """A rising sequence of integers from 0 to below ``universe``.

    The low bits of the values lie side by side; the others are coded in unary, as a bit
    vector with one set bit per value. A directory counts the set bits before each block.
    """

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        self.count = len(values)
        self.universe = int(values[-1]) + 1 if self.count else 1
        self.low_bits = max(0, (self.universe // max(1, self.count)).bit_length() - 1)
        place = (values >> np.uint64(self.low_bits)).astype(np.int64) + np.arange(self.count)
        bits = np.zeros(-(-(self.count + (self.universe >> self.low_bits) + 2) // BLOCK) * BLOCK, dtype=np.uint8)
        bits[place] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.cumsum(np.bitwise_count(high), dtype=np.int64)
        ranks = np.concatenate([[0], ones[:-1]])
        shifts = np.arange(self.low_bits, dtype=np.uint64)
        low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        self.parts = [high, ranks, np.arange(len(ranks)) * BLOCK - ranks, np.concatenate([low, np.zeros(8, dtype=np.uint8)])]

    def _low(self, places: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(places), dtype=np.uint64)
        low = self.parts[3]
        at = places * self.low_bits
        eight = np.ndarray((len(low) - 7,), dtype="<u8", buffer=low, strides=(1,))
        return eight[at >> 3] >> (at & 7).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th set (or unset) bit, from 0."""
        high, before = self.parts[0], self.parts[1 if one else 2]
        block = np.searchsorted(before, k, side="right") - 1
        left = (k - before[block]).astype(np.uint64)
        word = high[block] if one else ~high[block]
        # Set bits up to and with each byte, in that byte; then the bytes whose sum is not
        # above what is left.
        sums = word - (word >> np.uint64(1) & np.uint64(0x5555555555555555))
        sums = (sums & np.uint64(0x3333333333333333)) + (sums >> np.uint64(2) & np.uint64(0x3333333333333333))
        sums = (sums + (sums >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * ONES
        shift = np.bitwise_count(((left * ONES | TOPS) - sums) & TOPS).astype(np.uint64) * np.uint64(8)
        left -= (sums << np.uint64(8)) >> shift & np.uint64(0xFF)
        octet = word >> shift & np.uint64(0xFF)
        return block * BLOCK + shift.astype(np.int64) + _PLACES[octet, left]

    def _run(self, bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """How many set bits follow one another from the given places on."""
        octets = self.parts[0].view(np.uint8)
        eight = np.ndarray((len(octets) - 7,), dtype="<u8", buffer=octets, strides=(1,))
        at = np.minimum(bits >> 3, len(octets) - 8)
        unset = ~(eight[at] >> (bits - (at << 3)).astype(np.uint64))
        length = np.bitwise_count((unset & (~unset + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        long = np.flatnonzero(length + (bits - (at << 3)) >= 64)
        length[long] = self._select(bucket[long], False) - bits[long]
        return length

    def get(self, places: np.ndarray) -> np.ndarray:
        high = (self._select(places, True) - places).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(places)

    def successors(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, equal): the first place with a value not below each given one, the
        count if there is none, and whether that place holds the value itself."""
        inside = values < self.universe
        values = np.where(inside, values, 0).astype(np.uint64)
        bucket = (values >> np.uint64(self.low_bits)).astype(np.int64)
        low = values & np.uint64((1 << self.low_bits) - 1)
        # A bucket's values are the set bits after the unset one that ends the bucket before.
        after = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), False) + 1, 0)
        start = after - bucket
        end = start + self._run(after, bucket)
        stop = end.copy()
        open_ = np.flatnonzero(start < stop)
        while len(open_):
            middle = (start[open_] + stop[open_]) >> 1
            less = self._low(middle) < low[open_]
            start[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less]
            open_ = open_[start[open_] < stop[open_]]
        equal = inside & (start < end)
        equal[equal] = self._low(start[equal]) == low[equal]
        return np.where(inside, start, self.count), equal


def changes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """For each column whether it, or one before it, differs from the row above."""
    found, new = [], np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for column in columns:
        new = new.copy()
        new[1:] |= column[1:] != column[:-1]
        found.append(new)
    return found


class Trie:
    """N-grams, given as columns of word ids in their order and without repeats, with codes."""

    def __init__(self, columns: list[np.ndarray], codes: np.ndarray):
        self.pointers: list[EliasFano] = []
        self.levels: list[EliasFano] = []
        above = np.zeros(len(codes), dtype=bool)
        above[:1] = True
        for column, new in zip(columns, changes(columns), strict=True):
            ids = column[new].astype(np.int64)
            starts = np.flatnonzero(above[new])
            lasts = ids[np.append(starts[1:], len(ids)) - 1] if len(ids) else ids
            raised = np.concatenate([[0], np.cumsum(lasts + 1)[:-1]]) if len(ids) else ids
            owner = np.cumsum(above[new]) - 1
            self.pointers.append(EliasFano(np.append(starts, len(ids))))
            self.levels.append(EliasFano(ids + raised[owner] if len(ids) else ids))
            above = new
        sequences = [*self.pointers, *self.levels]
        memory = iter(mapped([codes, *[part for s in sequences for part in s.parts]]))
        self.codes = next(memory)
        for s in sequences:
            s.parts = [next(memory) for _ in s.parts]

    def find(self, columns: list[np.ndarray]) -> np.ndarray:
        """Codes of n-grams, given like those of the trie; 0 for those it lacks."""
        count = len(columns[0])
        if not len(self.codes) or not count:
            return np.zeros(count, dtype=np.uint16)
        # Node of each query's context. Contexts that repeat are followed once.
        context, first = np.zeros(1, dtype=np.int64), np.zeros(count, dtype=np.int64)
        for column, new, pointers, level in zip(columns, changes(columns), self.pointers, self.levels, strict=True):
            known = context >= 0
            node = context[known]
            begin, end = pointers.get(node).astype(np.int64), pointers.get(node + 1).astype(np.int64)
            raised = np.where(begin > 0, level.get(np.maximum(begin - 1, 0)).astype(np.int64) + 1, 0)
            bounds = np.full((2, len(context)), -1, dtype=np.int64)
            bounds[0, known], bounds[1, known] = end, raised
            owner = first[new]
            end, raised = bounds[0, owner], bounds[1, owner]
            found = np.full(len(owner), -1, dtype=np.int64)
            asked = np.flatnonzero(end >= 0)
            place, equal = level.successors((raised[asked] + column[new][asked].astype(np.int64)).astype(np.uint64))
            equal &= place < end[asked]
            found[asked[equal]] = place[equal]
            context, first = found, np.cumsum(new) - 1
        hits = context[first]
        return np.where(hits >= 0, self.codes[np.maximum(hits, 0)], 0).astype(np.uint16)

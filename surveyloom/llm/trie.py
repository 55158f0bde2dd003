"""Elias-Fano n-gram trie: monotone levels in one buffer that can be memory-mapped."""

from __future__ import annotations

import numpy as np

WORD = np.uint64(64)
ONE = np.uint64(1)
# With fewer queries than this part of a level's numbers each is searched for by itself.
FEW = 16


def packed_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits one after the other in 64-bit words."""
    n = len(values) * width
    out = np.zeros(n // 64 + 2, np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(out, word, values << shift)
        over = np.nonzero(shift + np.uint64(width) > WORD)[0]
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (WORD - shift[over]))
    return out


class EliasFano:
    """A rising sequence of n numbers: low bits side by side, high bits in unary, counts of ones for jumps.

    ``parts`` are the arrays to store; the object only looks into them.
    """

    def __init__(self, parts: list[np.ndarray]):
        self.head, self.low, self.high, self.ones = parts
        self.n, self.width = int(self.head[0]), int(self.head[1])

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        most = int(values[-1]) + 1 if n else 1
        width = max(0, (most // max(n, 1)).bit_length() - 1)
        low = packed_bits(values & np.uint64((1 << width) - 1), width)
        place = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        high = np.zeros((int(place[-1]) >> 6) + 1 if n else 1, np.uint64)
        np.bitwise_or.at(high, (place >> np.uint64(6)).astype(np.int64), ONE << (place & np.uint64(63)))
        ones = np.zeros(len(high) + 1, np.uint64)
        np.cumsum(np.bitwise_count(high), out=ones[1:])
        return cls([np.array([n, width], np.uint64), low, high, ones])

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.head, self.low, self.high, self.ones]

    def get(self, index: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        index = np.asarray(index, np.int64)
        word = np.searchsorted(self.ones, index.astype(np.uint64), "right") - 1
        left = (index.astype(np.uint64) - self.ones[word]).astype(np.int64)
        bits, at = self.high[word], np.zeros(len(index), np.int64)
        # Halve the word until the one that is wanted remains.
        for half in (32, 16, 8, 4, 2, 1):
            lower = bits & np.uint64((1 << half) - 1)
            count = np.bitwise_count(lower).astype(np.int64)
            up = left >= count
            left -= np.where(up, count, 0)
            at += np.where(up, half, 0)
            bits = np.where(up, bits >> np.uint64(half), lower)
        high = (word * 64 + at - index).astype(np.uint64)
        if not self.width:
            return high
        start = index.astype(np.uint64) * np.uint64(self.width)
        cell, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
        # Shifts by 64 are undefined, so the next word is shifted in two steps.
        low = (self.low[cell] >> shift) | ((self.low[cell + 1] << (np.uint64(63) - shift)) << ONE)
        return (high << np.uint64(self.width)) | (low & np.uint64((1 << self.width) - 1))

    def all(self) -> np.ndarray:
        """All numbers, at a fraction of what asking for each would cost."""
        place = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        high = (place - np.arange(self.n)).astype(np.uint64)
        if not self.width:
            return high
        start = np.arange(self.n, dtype=np.uint64) * np.uint64(self.width)
        cell, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
        low = (self.low[cell] >> shift) | ((self.low[cell + 1] << (np.uint64(63) - shift)) << ONE)
        return (high << np.uint64(self.width)) | (low & np.uint64((1 << self.width) - 1))

    def successor(self, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """For each range [low, high): the place of its first number not below ``wanted``, ``high`` if there is none."""
        low, high = low.astype(np.int64).copy(), high.astype(np.int64).copy()
        going = np.nonzero(low < high)[0]
        while len(going):
            middle = (low[going] + high[going]) >> 1
            below = self.get(middle) < wanted[going]
            low[going[below]] = middle[below] + 1
            high[going[~below]] = middle[~below]
            going = going[low[going] < high[going]]
        return low


class Trie:
    """Contexts, where each one's successors begin, successors, and a code for each.

    A context's successors are stored relative to what stood before them: each
    plus the last number of the context before, so that the whole level rises.
    """

    LEVELS = 3

    def __init__(self, contexts: EliasFano, begins: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.begins, self.successors, self.codes = contexts, begins, successors, codes

    @classmethod
    def build(cls, contexts: np.ndarray, successors: np.ndarray, codes: np.ndarray) -> Trie:
        """From (context, successor) pairs in rising order, each once."""
        known, first = np.unique(contexts, return_index=True)
        last = np.append(first[1:], len(contexts)) - 1
        before = np.concatenate([[0], np.cumsum(successors[last])[:-1]]) if len(known) else np.zeros(0)
        rising = successors + np.repeat(before, last + 1 - first).astype(successors.dtype)
        begins = np.append(first, len(contexts))
        return cls(*map(EliasFano.build, (known, begins, rising)), np.asarray(codes, np.uint16))

    def find(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """The code of each pair, 0 where it is not in the trie."""
        out = np.zeros(len(contexts), np.uint16)
        n = self.contexts.n
        if not n or not len(contexts):
            return out
        # Equal contexts are looked up once.
        some, which = np.unique(contexts, return_inverse=True)
        some = some.astype(np.uint64)
        if len(contexts) * FEW > self.successors.n:
            return self._find_many(some, which, successors, out)
        at = self.contexts.successor(np.zeros(len(some)), np.full(len(some), n), some)
        at = np.where((at < n) & (self.contexts.get(np.minimum(at, n - 1)) == some), at, -1)
        rows = np.nonzero(at[which] >= 0)[0]
        if not len(rows):
            return out
        at = at[which[rows]]
        begin, end = self.begins.get(at).astype(np.int64), self.begins.get(at + 1).astype(np.int64)
        before = np.where(begin > 0, self.successors.get(np.maximum(begin - 1, 0)), 0).astype(np.uint64)
        wanted = successors[rows].astype(np.uint64) + before
        place = self.successors.successor(begin, end, wanted)
        hit = place < end
        hit[hit] = self.successors.get(place[hit]) == wanted[hit]
        out[rows[hit]] = self.codes[place[hit]]
        return out

    def _find_many(self, some: np.ndarray, which: np.ndarray, successors: np.ndarray, out: np.ndarray) -> np.ndarray:
        """The same for so many pairs that reading each level through once costs less.

        Successors rise over the whole level, so the first one that is not below
        what is wanted relative to a context lies in that context's range or at its end.
        """
        known, begins, rising = self.contexts.all(), self.begins.all().astype(np.int64), self.successors.all()
        at = np.searchsorted(known, some)
        there = known[np.minimum(at, len(known) - 1)] == some
        rows = np.flatnonzero(there[which])
        if not len(rows):
            return out
        at = at[which[rows]]
        begin, end = begins[at], begins[at + 1]
        before = np.where(begin > 0, rising[np.maximum(begin - 1, 0)], np.uint64(0))
        wanted = successors[rows].astype(np.uint64) + before
        place = np.searchsorted(rising, wanted)
        # Where a context's first successor is 0 it equals the last number before it.
        place = np.maximum(place, begin)
        hit = place < end
        hit[hit] = rising[place[hit]] == wanted[hit]
        out[rows[hit]] = self.codes[place[hit]]
        return out

    def to_bytes(self) -> bytes:
        """All levels in one buffer: the lengths of the arrays, then the arrays, each from a multiple of eight."""
        arrays = [p for level in (self.contexts, self.begins, self.successors) for p in level.parts]
        arrays.append(np.concatenate([self.codes, np.zeros(-len(self.codes) % 4, np.uint16)]).view(np.uint64))
        sizes = np.array([len(self.codes), *map(len, arrays)], np.uint64)
        return b"".join(a.tobytes() for a in (sizes, *arrays))

    @classmethod
    def view(cls, buffer) -> Trie:
        """A trie over a buffer, such as a memory-mapped file; nothing is copied."""
        words = np.frombuffer(buffer, np.uint64)
        many = 4 * cls.LEVELS + 1
        sizes = words[1 : 1 + many].astype(np.int64)
        bounds = 1 + many + np.concatenate([[0], np.cumsum(sizes)])
        arrays = [words[a:b] for a, b in zip(bounds, bounds[1:])]
        levels = [EliasFano(arrays[4 * i : 4 * i + 4]) for i in range(cls.LEVELS)]
        return cls(*levels, arrays[-1].view(np.uint16)[: int(words[0])])

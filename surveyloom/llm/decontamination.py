"""Benchmark decontamination: SimHash of item-sized windows, multi-index search, exact check."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from surveyloom.llm.common import map_batches, spaced_words, utf8
from surveyloom.llm.simhash import BITS, bits_of, value_of
from surveyloom.session import store

LENGTH = 5
SIMILARITY = 0.8
# Four blocks of 16 bits, each searched within 3 bits: fingerprints 15 bits apart differ by at most 3 in one of them.
BLOCKS, NEAR = 4, 3
RADIUS = BLOCKS * (NEAR + 1) - 1
WIDTH = BITS // BLOCKS
# Bytes of item text in one pass over the documents; more items take more passes.
ITEM_BYTES = 16 << 20
# Windows fingerprinted at once.
WINDOWS = 4096
# Fingerprints searched at once.
SEARCHED = 256
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
FLIPS = np.array([sum(1 << b for b in c) for n in range(NEAR + 1) for c in combinations(range(WIDTH), n)], np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = reduce(np.add, (words[i : i + n] * ODD[i] for i in range(length)))
    h ^= h >> np.uint64(29)
    h *= ODD[1]
    return h ^ (h >> np.uint64(32))


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, shingles: int) -> np.ndarray:
    """SimHash of the windows of so many shingles at ``starts``, which rise."""
    out = []
    at = 0
    while at < len(starts):
        # Starts close enough to share running sums.
        end = min(np.searchsorted(starts, starts[at] + WINDOWS), at + WINDOWS)
        group = starts[at:end]
        bits = bits_of(hashes[group[0] : group[-1] + shingles])
        sums = np.zeros((len(bits) + 1, BITS), np.int32)
        np.cumsum(bits, axis=0, out=sums[1:])
        first = group - group[0]
        out.append(value_of(2 * (sums[first + shingles] - sums[first]) > shingles))
        at = end
    return np.concatenate(out)


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Jaccard similarity of shingles weighted by how often each stands."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def bag(words: list[bytes], length: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(length))))


def sizes_by_shingle(shingles: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    both = np.unique(np.rec.fromarrays([shingles, sizes], names="shingle,size"))
    known, first = np.unique(both["shingle"], return_index=True)
    return known, np.ascontiguousarray(both["size"]), np.append(first, len(both))


class Items:
    """The index of one bounded block of items."""

    def __init__(self, items: list[tuple[object, bytes]], similarity: float = SIMILARITY):
        self.similarity = similarity
        self.ids, self.bags, prints, known = [], [], [], {}
        for ident, text in items:
            words = spaced_words(text)
            if not words:
                continue
            length = min(LENGTH, len(words))
            h = shingle_hashes(word_hashes(words), length)
            known.setdefault(length, []).append((h, np.full(len(h), len(words))))
            self.ids.append(ident)
            self.bags.append(bag(words, length))
            prints.append(window_fingerprints(h, np.zeros(1, np.int64), len(h))[0])
        self.prints = np.array(prints, np.uint64)
        # By shingle length: the items' shingles, the sizes of the items that have each, where each one's sizes begin.
        self.known = {k: sizes_by_shingle(*map(np.concatenate, zip(*v))) for k, v in known.items()}
        # For each block of bits, the items in order of their value there and where each value begins.
        self.blocks = []
        for b in range(BLOCKS):
            value = self.block(self.prints, b)
            order = np.argsort(value, kind="stable")
            self.blocks.append((order, np.searchsorted(value[order], np.arange((1 << WIDTH) + 1))))

    @staticmethod
    def block(prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(b * WIDTH)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs within ``RADIUS`` bits, in order."""
        pairs = []
        for b, (order, begin) in enumerate(self.blocks):
            keys = (self.block(prints, b)[:, None] ^ FLIPS).reshape(-1)
            first, many = begin[keys], begin[keys + 1] - begin[keys]
            filled = np.nonzero(many)[0]
            window = np.repeat(filled // len(FLIPS), many[filled])
            # Places 0, 1, ... within each filled key.
            inside = np.arange(len(window)) - np.repeat(np.cumsum(many[filled]) - many[filled], many[filled])
            item = order[np.repeat(first[filled], many[filled]) + inside]
            close = np.bitwise_count(self.prints[item] ^ prints[window]) <= RADIUS
            pairs.append(window[close] * len(self.prints) + item[close])
        found = np.unique(np.concatenate(pairs))
        return found // len(self.prints), found % len(self.prints)

    def search(self, words: list[bytes]) -> dict[int, tuple[float, int, int, int]]:
        """item: (similarity, bits apart, first word, words) of the most similar window, the first of equal ones.

        A window can only be similar enough to an item of its size if nearly all
        its shingles are shingles of such items, so only such windows are
        fingerprinted.
        """
        best: dict[int, tuple[float, int, int, int]] = {}
        hashed = word_hashes(words)
        for length, (known, sizes, begin) in self.known.items():
            h = shingle_hashes(hashed, length)
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            places = np.nonzero(known[at] == h)[0]
            if not len(places):
                continue
            at = at[places]
            many = begin[at + 1] - begin[at]
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            size_at, place_at = sizes[np.repeat(begin[at], many) + inside], np.repeat(places, many)
            for size in np.unique(size_at).tolist():
                n = size - length + 1
                if n > len(h):
                    continue
                hits = np.zeros(len(h) + 1, np.int64)
                hits[place_at[size_at == size] + 1] = 1
                np.cumsum(hits, out=hits)
                # Both bags hold n shingles, so similarity s needs 2ns / (1 + s) of them in common.
                need = 2 * n * self.similarity / (1 + self.similarity)
                starts = np.nonzero(hits[n:] - hits[:-n] >= need - 1e-9)[0]
                if not len(starts):
                    continue
                for i in range(0, len(starts), SEARCHED):
                    at = starts[i : i + SEARCHED]
                    self._verify(words, at, window_fingerprints(h, at, n), size, length, best)
        return best


    def _verify(self, words, starts, prints, size: int, length: int, best: dict) -> None:
        """Keep each item's most similar window by the exact check."""
        held, bag_of = None, None
        for window, item in zip(*(x.tolist() for x in self.near(prints))):
            if item in best and best[item][0] == 1.0:
                continue
            start = int(starts[window])
            if held != window:
                held, bag_of = window, bag(words[start : start + size], length)
            alike = weighted_similarity(bag_of, self.bags[item])
            if alike >= self.similarity and (item not in best or (-alike, start) < (-best[item][0], best[item][2])):
                best[item] = (alike, int(np.bitwise_count(self.prints[item] ^ prints[window])), start, size)


def item_blocks(items: DataFrame, ident: str, text: str, most: int) -> tuple[int, Iterator[list[tuple[object, bytes]]]]:
    """(how many, items in blocks of bounded size): each block is collected when it is asked for."""
    kept = items.where(F.col(text).isNotNull()).select(F.col(ident).alias("ident"), F.encode(text, "UTF-8").alias("text"))
    total = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // most) or 1
    part = F.pmod(F.xxhash64("ident", "text"), F.lit(parts))
    blocks = (
        sorted(((r["ident"], bytes(r["text"])) for r in kept.where(part == i).collect()), key=lambda x: (str(x[0]), x[1]))
        for i in range(parts)
    )
    return parts, blocks


def by_block(items: DataFrame, ident: str, text: str, similarity: float, make: Callable, name: str) -> Iterator[DataFrame]:
    """``make(index)`` for the broadcast index of each block of items.

    With several blocks each result is stored and its index given up before the
    next block is collected, so the driver never holds more than one.
    """
    many, blocks = item_blocks(items, ident, text, ITEM_BYTES)
    for block in blocks:
        shared = items.sparkSession.sparkContext.broadcast(Items(block, similarity))
        made = make(shared)
        if many > 1:
            made = store(made, name)
            shared.destroy()
        yield made


def leaks(
    docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(doc, item, similarity, bits, first_word, n_words) for every item a document holds, at its best window.

    A window has as many words as the item; its fingerprint lies within
    ``RADIUS`` bits of the item's and the weighted similarity of their five-word
    shingles is ``similarity`` or more. Items of fewer words are one shingle.

    Null and empty texts and items match nothing; repeated documents and items
    come out repeated; null ids are kept; empty tables give no rows. Other
    columns are not looked at. Documents are not shuffled; items go to the
    tasks in blocks of bounded size, one pass over the documents for each.
    """
    kinds = docs.schema[doc].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"doc {kinds[0]}, item {kinds[1]}, similarity double, bits int, first_word long, n_words long"
    narrow = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))

    def search_with(shared):
        def search(batch: pa.RecordBatch) -> pa.RecordBatch:
            index, rows, places = shared.value, [], []
            for place, t in enumerate(utf8(batch.column(1))):
                for i, found in sorted(index.search(spaced_words(t)).items()):
                    rows.append((index.ids[i], *found))
                    places.append(place)
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (None, pa.float64(), pa.int32(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k or item_kind) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places, pa.int64())), *arrays],
                ["doc", "item", "similarity", "bits", "first_word", "n_words"],
            )

        return search

    item_kind = to_arrow_type(items.schema[item].dataType)
    parts = by_block(items, item, text, similarity, lambda shared: map_batches(narrow, search_with(shared), schema), "leaks")
    return reduce(DataFrame.unionAll, parts).withColumnsRenamed({"doc": doc, "item": item})


def without_leaks(docs: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no item by :func:`leaks`, with all their columns."""
    place, kept = docs.columns.index(text), docs

    def clean_with(shared) -> DataFrame:
        def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(
                pa.array([not shared.value.search(spaced_words(t)) for t in utf8(batch.column(place))], pa.bool_())
            )

        return map_batches(kept, clean, kept.schema)

    for left in by_block(items, item, text, similarity, clean_with, "clean"):
        kept = left
    return kept

"""Packing documents into sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain, filterfalse
from pathlib import Path
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches, rank_within
from surveyloom.session import ship_package, store

# Characters of text whose new words are encoded together, and words and pre-tokens remembered between them.
TEXT_CHARS = 4 << 20
REMEMBERED = 300_000
# Pre-tokens encoded in one string.
JOINED = 1000
# The tokenizer's pre-tokens and the mark at their end.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
END = "</w>"
# What Python takes for white space and the tokenizer does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class Generations:
    """Values by key in two generations: when the young one is full it becomes the old one.

    What is asked for comes back from the old one; the rest is forgotten, which
    costs time but changes no result.
    """

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that have to be made; all others can be looked up in ``young``."""
        new = keys.difference(self.young)
        if len(self.young) + len(new) > self.most:
            self.old, self.young, new = self.young, {}, keys
        again = new.intersection(self.old)
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        return list(new - again)


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes, each distinct pre-token encoded once.

    For tokenizers that compose (NFC) and lower-case a text, drop white space,
    split it by ``PRE_TOKEN`` and end every pre-token with a token marked
    ``END``. White space is then nothing but a boundary, so ids are remembered
    for whole words between white space, and many pre-tokens can be encoded in
    one string and told apart by their ends. Texts with special strings, or not
    composed, are encoded as they stand.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(END)]] = True
        self.words, self.tokens = Generations(REMEMBERED), Generations(REMEMBERED)

    def encode(self, texts: list[str]) -> list[bytes]:
        lower = list(map(self._lower, texts))
        # The words between white space, each distinct one once: Python sees only those.
        words = pc.utf8_split_whitespace(pa.array([t or "" for t in lower], pa.large_string()))
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._remember(set(distinct))
        known = self.words.young
        pieces = [known[w] for w in distinct]
        size = np.array(list(map(len, pieces)), np.int64) >> 2
        ids = np.frombuffer(b"".join(pieces), "<u4")
        codes = coded.indices.to_numpy()
        sizes = size[codes]
        # Each word's ids are taken from where they stand in ``ids``.
        ends = np.cumsum(sizes)
        shift = (np.cumsum(size) - size)[codes] - (ends - sizes)
        raw = ids[np.arange(int(sizes.sum())) + np.repeat(shift, sizes)].tobytes()
        bounds = (4 * np.concatenate([[0], ends])[words.offsets.to_numpy()]).tolist()
        return [
            self._one(text) if low is None else raw[a:b]
            for text, low, a, b in zip(texts, lower, bounds, bounds[1:])
        ]

    def _remember(self, words: set[str]) -> None:
        """Put the ids of these words where they can be looked up."""
        new = self.words.missing(words)
        # A word of letters is one pre-token.
        mixed = list(filterfalse(str.isalpha, new))
        parts = list(map(PRE_TOKEN.findall, mixed))
        self._learn(self.tokens.missing(set(chain.from_iterable(parts))), self.tokens.young)
        tokens = self.tokens.young.__getitem__
        self.words.young.update(zip(mixed, [b"".join(map(tokens, p)) for p in parts]))
        self._learn(list(filter(str.isalpha, new)), self.words.young)

    def _lower(self, text: str) -> str | None:
        """A text in lower case whose white space is a boundary and nothing else; None if it has to be encoded as it stands."""
        # Letters one at a time, as the tokenizer does it; only this one depends on its neighbours in Python.
        lower = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()
        if any(s in text for s in self.special) or any(s in lower for s in SEPARATORS):
            return None
        return lower if text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", lower) else None

    def _learn(self, parts: list[str], known: dict[str, bytes]) -> None:
        """Encode pre-tokens and put their ids into ``known``."""
        for i in range(0, len(parts), JOINED):
            group = parts[i : i + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, "<u4")
            after = np.nonzero(self.ends[ids])[0] + 1
            if len(after) == len(group) and after[-1] == len(ids):
                raw = ids.tobytes()
                bounds = (4 * after).tolist()
                known.update(zip(group, map(raw.__getitem__, map(slice, [0, *bounds[:-1]], bounds))))
            else:
                known.update((p, self._one(p)) for p in group)

    def _one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(count, lengths): how often to fill a sequence with these lengths in this order.

    Lengths are placed longest first, each into the pack with the most room
    left, all packs of a pattern at once; the histogram is all it needs, so the
    number of documents does not matter.
    """
    # A pattern is a chain: (length, the pattern before it).
    open_packs: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []
    done: list[tuple[int, tuple]] = []

    def put(count: int, pattern: tuple, room: int) -> None:
        if not room:
            done.append((count, pattern))
            return
        if not open_packs.get(room):
            open_packs[room] = []
            heappush(rooms, -room)
        open_packs[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or -rooms[0] < length:
                put(left, (length, None), size - length)
                break
            room = -rooms[0]
            count, pattern = open_packs[room].pop()
            taken = min(count, left)
            if taken < count:
                open_packs[room].append((count - taken, pattern))
            if not open_packs[room]:
                heappop(rooms)
            put(taken, (length, pattern), room - length)
            left -= taken
    done += [p for room in sorted(open_packs) for p in open_packs[room]]
    out = []
    for count, pattern in done:
        lengths = []
        while pattern:
            lengths.append(pattern[0])
            pattern = pattern[1]
        out.append((count, lengths[::-1]))
    return out


class Places:
    """Where the piece with a given length and rank among equal lengths goes."""

    def __init__(self, patterns: list[tuple[int, list[int]]]):
        rows: dict[int, list[tuple[int, int, int]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for count, lengths in patterns:
            offset = 0
            for length in lengths:
                first = taken.get(length, 0)
                rows.setdefault(length, []).append((first, base, offset))
                taken[length] = first + count
                offset += length
            base += count
        self.rows = {length: np.array(r, np.int64).T for length, r in rows.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
        for value in np.unique(length):
            rows = length == value
            first, base, at = self.rows[int(value)]
            i = np.searchsorted(first, rank[rows], "right") - 1
            sequence[rows] = base[i] + rank[rows] - first[i]
            offset[rows] = at[i]
        return sequence, offset


def pieces(df: DataFrame, tokenizer: str, ident: str, text: str, size: int, end: int) -> DataFrame:
    """(ident, start, length, ids_crc32, doc_tokens): every document's ids, closed by ``end``, cut every ``size`` ids."""
    spark = df.sparkSession
    ship_package(spark)
    # The file has a fixed size.
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text())
    kind = df.schema[ident].dataType.simpleString()
    close = end.to_bytes(4, "little")
    names = ["ident", "start", "length", "ids_crc32", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(definition.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            first = 0
            while first < len(texts):
                last, held = first, 0
                while last < len(texts) and held < TEXT_CHARS:
                    held += len(texts[last])
                    last += 1
                rows = []
                for row, ids in enumerate(encoder.encode(texts[first:last]), first):
                    ids += close
                    for at in range(0, len(ids), 4 * size):
                        piece = ids[at : at + 4 * size]
                        rows.append((row, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                row, *columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), *(pa.array(c, pa.int64()) for c in columns)], names
                )
                first = last

    return df.select(F.col(ident).alias("ident"), F.col(text).alias("text")).mapInArrow(
        cut, f"ident {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    )


def pack(df: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text", size: int = 4096, end: int = 2) -> DataFrame:
    """(ident, start, length, ids_crc32, doc_tokens, sequence_id, offset): a row for each piece of a document.

    ``tokenizer`` is the path of a tokenizer file as :class:`Encoder` takes it. A
    document of more than ``size`` ids is cut into full pieces and a rest. The
    histogram of piece lengths, ``size`` numbers at most, decides the patterns;
    a piece finds its pattern by its rank among the pieces of its length.

    Null and empty texts are the end id alone; null ids and repeated rows are
    packed like any other; an empty table gives no rows. Other columns are not
    looked at.
    """
    stored = store(
        pieces(df, tokenizer, ident, text, size, end).withColumn("place", F.monotonically_increasing_id()), "pieces"
    )
    histogram = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    # As many rows as the patterns have places: it follows the number of different lengths, not of documents.
    places = stored.sparkSession.sparkContext.broadcast(Places(shortest_pack_first(histogram, size)))
    ranked = rank_within(stored, ["length"], "place", "rank").drop("place")

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index
        sequence, offset = places.value.find(batch.column(at("length")).to_numpy(), batch.column(at("rank")).to_numpy())
        kept = [batch.column(at(n)) for n in ("ident", "start", "length", "ids_crc32", "doc_tokens")]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(sequence), pa.array(offset)],
            ["ident", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    kind = df.schema[ident].dataType.simpleString()
    schema = f"ident {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_batches(ranked, find, schema).withColumnRenamed("ident", ident)

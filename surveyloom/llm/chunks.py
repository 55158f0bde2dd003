"""Bounded chunks of documents that look words up in a vocabulary spread over the cluster.

A chunk numbers its own distinct words. It sends each once, with its number,
to the bucket the word hashes to; the bucket sees a word once per chunk,
works once per distinct word and replies to each chunk by its numbers. So
word occurrences are never shuffled, and a word in every document is one row
per chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

# Bytes of text in a chunk; a longer text is a chunk of its own.
TEXT_BYTES = 16 << 20
CHUNK_BITS = 24


def _packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each number ends in them)."""
    values = np.asarray(values, np.uint64)
    size = np.ones(len(values), np.int64)
    most = int(values.max())
    for n in range(1, 9):
        if most < 1 << (7 * n):
            break
        size += values >= np.uint64(1 << (7 * n))
    end = np.cumsum(size)
    out = np.zeros(end[-1], np.uint8)
    begin = end - size
    for n in range(int(size.max())):
        more = np.flatnonzero(size > n) if n else slice(None)
        part = ((values[more] >> np.uint64(7 * n)) & np.uint64(0x7F)).astype(np.uint8)
        out[begin[more] + n] = part | ((size[more] > n + 1).astype(np.uint8) << 7)
    return out, end


def pack_ints(values: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2^63-1, seven bits a byte, low bits first; the high bit says that more follow."""
    return _packed(values)[0].tobytes() if len(values) else b""


def pack_runs(values: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """``pack_ints`` of each of the runs that ``values`` are made of, all packed together."""
    if not len(values):
        return [b""] * len(lengths)
    out, end = _packed(values)
    raw = out.tobytes()
    bounds = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(lengths)])].tolist()
    return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


def unpack_ints(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 0x80)
    if len(last) == len(raw):
        return raw.astype(np.int64)
    first = np.concatenate([[0], last[:-1] + 1])
    size = last - first + 1
    out = (raw[first] & 0x7F).astype(np.int64)
    for n in range(1, int(size.max())):
        more = np.flatnonzero(size > n)
        out[more] |= (raw[first[more] + n] & 0x7F).astype(np.int64) << (7 * n)
    return out


def unpack_runs(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers of all, how many each holds) of what ``pack_ints`` gave."""
    raw = b"".join(packed)
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint8) < 0x80)])
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in packed])]).astype(np.int64)
    return unpack_ints(raw), np.diff(ends[bounds])


def pack_rising(values: np.ndarray) -> bytes:
    """Rising whole numbers, by their differences."""
    return pack_ints(np.diff(values, prepend=0))


def unpack_rising(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(packed))


def chunked(
    batches: Iterator[pa.RecordBatch], texts_of: Callable[[pa.RecordBatch], list], emit: Callable[[int, pa.Table, list], Iterator]
) -> Iterator[pa.RecordBatch]:
    """Gather rows into chunks of bounded text and hand each to ``emit(chunk, rows, texts)``."""
    part = TaskContext.get().partitionId() << CHUNK_BITS
    chunk, rows, texts, size = 0, [], [], 0
    for batch in batches:
        found = texts_of(batch)
        first = 0
        for i, text in enumerate(found):
            size += len(text)
            if size > TEXT_BYTES:
                rows.append(batch.slice(first, i + 1 - first))
                yield from emit(part + chunk, pa.Table.from_batches(rows), texts + found[first : i + 1])
                chunk, rows, texts, size, first = chunk + 1, [], [], 0, i + 1
        if first < len(found):
            rows.append(batch.slice(first))
            texts = texts + found[first:]
    if rows:
        yield from emit(part + chunk, pa.Table.from_batches(rows), texts)


def bucket_of(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def buckets_for(df: DataFrame) -> int:
    """How many buckets share the words: two for each task that reads text, as each sends a bounded share."""
    return max(8, 2 * df.rdd.getNumPartitions())


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indexes in it), for each bucket that has any."""
    order = np.argsort(buckets, kind="stable")
    values, first = np.unique(buckets[order], return_index=True)
    return zip(values.tolist(), np.split(order, first[1:]))

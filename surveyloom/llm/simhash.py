"""SimHash fingerprints of 64 bits."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash

from surveyloom.llm.common import spaced_words

BITS = 64
SEED = 42


def shingles(words: list[bytes], length: int) -> list[bytes]:
    """Every run of ``length`` words, repeats included; the whole sequence where there are fewer."""
    if not words:
        return []
    if len(words) <= length:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*(words[i:] for i in range(length)))))


def hashes(items: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, items, repeat(SEED)), np.uint64, len(items))


def bits_of(values: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones for each value, highest bit first."""
    return np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def value_of(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1).view(">u8").astype(np.uint64).reshape(-1)


def fingerprint(values: np.ndarray, block: int = 1 << 16) -> int:
    """A bit is 1 where more than half of the values have it; 0 for no values."""
    if not len(values):
        return 0
    set_bits = np.zeros(BITS, np.int64)
    for i in range(0, len(values), block):
        set_bits += bits_of(values[i : i + block]).sum(axis=0, dtype=np.int32)
    return int(value_of(2 * set_bits > len(values))[0])


def text_fingerprint(text: bytes, length: int) -> int:
    return fingerprint(hashes(shingles(spaced_words(text), length)))

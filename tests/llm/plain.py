"""Plain versions of the operators, and small corpora, for the tests."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return SPACED.findall((text or "").encode().lower())


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def simhash(text, length=3):
    words = spaced(text)
    shingles = [b" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def components(n, pairs):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def near_pairs(values, radius):
    values = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.nonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius)[0]:
            yield i, i + 1 + int(j)


def corpus(n, seed=0, words=400):
    """(doc_id, text): prose of invented words, every fifth a near copy of the one before, every seventh an exact one."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefgéüñ") for _ in range(rnd.randint(2, 8))) for _ in range(800)]
    out = []
    for i in range(n):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, words))]
        if out and i % 7 == 3:
            text = out[-1][1].split()
        elif out and i % 5 == 2:
            text = out[-1][1].split()
            text[rnd.randrange(len(text))] = "changed"
        out.append((i, " ".join(text).capitalize() + "."))
    return out


# Null ids and texts, empty and long texts, repeated rows, odd characters.
ODD = [
    (None, None), (None, "a b c"), (1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "word " * 60_000), (6, "same text here now"),
    (6, "same text here now"), (7, "Ünïcode 漢字 ‮     é \U0001f469‍\U0001f469"), (8, "same text here now"),
]
# Columns whose names the operators use inside.
CLASHES = ["ident", "fp", "place", "leaf", "chunk", "bucket", "rank", "score", "key", "slot", "length", "toxic"]


def odd_documents(spark, rows=ODD):
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, *CLASHES) for r in rows], schema)

import random

import numpy as np

from plain import ODD, components, corpus, near_pairs, odd_documents, simhash
from surveyloom.llm import near_dedup
from surveyloom.llm.components import connected


def expected(rows):
    prints = [simhash(t) for _, t in rows]
    roots = components(len(rows), near_pairs(prints, 2))
    least = {}
    for (ident, _), root in zip(rows, roots):
        if ident is not None:
            least[root] = min(ident, least.get(root, ident))
    return sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, prints, roots)), key=str)


def test_components_equal_brute_force(spark):
    rows = corpus(250) + ODD[2:]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_odd_rows(spark):
    got = near_dedup.near_duplicates(odd_documents(spark)).collect()
    assert sorted(map(tuple, got), key=str) == expected(ODD)
    assert near_dedup.near_duplicates(odd_documents(spark, [])).count() == 0


def clustered(n, seed=1):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(max(1, n // 20))]
    out = set()
    while len(out) < n:
        value = rnd.choice(centres)
        for _ in range(rnd.randint(0, 6)):
            value ^= 1 << rnd.randrange(64)
        out.add(value)
    return np.array(sorted(out), np.uint64)


def test_links_span_all_near_pairs(monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL", 8)
    for values in (clustered(600), np.arange(300, dtype=np.uint64), clustered(1)):
        a, b = near_dedup.links(values, np.ones(len(values), bool), 2)
        assert components(len(values), zip(a.tolist(), b.tolist())) == components(len(values), near_pairs(values, 2))
        assert len(a) < len(values)


def test_every_near_pair_meets_in_a_home():
    values = clustered(1500)
    tree = near_dedup.Tree(values[::3], 32, 4)
    leaf, index, home = tree.deal(values, 2)
    assert tree.leaves > 8 and home.sum() == len(values)
    where = {}
    for at, i, h in zip(leaf.tolist(), index.tolist(), home.tolist()):
        where.setdefault(i, {})[at] = h
    for i, j in near_pairs(values, 2):
        assert any(where[i][at] or where[j][at] for at in where[i].keys() & where[j].keys())


def test_blocks_of_a_large_shard_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 50)
    values = clustered(400)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = [(r["a"], r["b"]) for r in near_dedup.linked_fingerprints(frame, 2).collect()]
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    got = components(len(values), [(place[a], place[b]) for a, b in links])
    assert got == components(len(values), near_pairs(values, 2))


def test_connected_chain_star_and_random(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    edges += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    roots = components(400, edges)
    assert got == {n: roots[n] for e in edges for n in e}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0

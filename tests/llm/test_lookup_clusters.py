import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from surveyloom.llm import lookup_clusters


def start():
    return F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)


def plain(rows, k, rounds, dims, scale):
    kept = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < lookup_clusters.LARGEST / scale for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((i, v, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centres)):
            mine = [v for _, v, of, _ in found if of == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    total = sum(d for *_, d in found)
    sums = [sum(d for *_, of, d in found if of == c) for c in range(len(centres))]
    return sorted((str(i), c, d, sums[c], total) for i, _, c, d in found), centres


def clustered(frame, **more):
    out, centres = lookup_clusters.cluster(frame, start=start(), **more)
    rows = sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"]) for r in out.collect())
    return rows, centres


def vectors(n, dims, seed=0):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(i % 5, 0.3) for _ in range(dims)]) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("block", [4096, 7])
def test_equals_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(lookup_clusters, "BLOCK", block)
    rows = [(i, [float(int(x * 64)) / 64 for x in v]) for i, v in vectors(300, 6)]
    got, centres = clustered(spark.createDataFrame(rows, SCHEMA).repartition(5), k=4, rounds=5, dims=6, scale=128)
    want, wanted = plain(rows, 4, 5, 6, 128)
    assert got == want and centres == wanted


def test_vectors_that_take_no_part_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 0.0]), (2, [0.0, 0.0]), (2, [0.0, 0.0]), (2, [1.0, 0.5]), (None, [0.25, 0.25]), (3, None), (4, []), (5, [1.0]),
        (6, [1.0, None]), (7, [nan, 0.0]), (8, [inf, 0.0]), (9, [-inf, 0.0]), (10, [1e30, 0.0]), (11, [-0.5, -0.00001]), (12, [1.0, 2.0, 3.0]),
    ]
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA + ", ident string, whole string, cluster string")
    # One more centroid than there are different vectors: equal centroids, the second of which stays empty.
    for k in (1, 3, 8, 20):
        got, centres = clustered(frame, k=k, rounds=4, dims=2, scale=1024)
        want, wanted = plain(rows, k, 4, 2, 1024)
        assert got == want and centres == wanted


def test_large_components_stay_exact(spark):
    edge = lookup_clusters.LARGEST - 1
    rows = [(i, [float(edge if i % 2 else -edge)] * 3) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, centres = clustered(frame, k=1, rounds=2, dims=3, scale=1)
    assert (got, centres) == plain(rows, 1, 2, 3, 1)
    assert got[0][2] == 3 * (edge - centres[0][0]) ** 2 or got[0][2] == 3 * (edge + centres[0][0]) ** 2


def test_no_vectors(spark):
    frame = spark.createDataFrame([], SCHEMA)
    got, centres = clustered(frame, k=8, rounds=10)
    assert got == [] and centres == []
    assert clustered(spark.createDataFrame([(1, None)], SCHEMA), k=8, rounds=10)[0] == []


def test_tables_give_the_squared_distances():
    import numpy as np

    rng = np.random.default_rng(0)
    rows = rng.integers(-50, 50, (100, 4))
    values, codes = zip(*(np.unique(rows[:, d], return_inverse=True) for d in range(4)))
    block = lookup_clusters.Block(
        np.concatenate(values).astype("<i8").tobytes(), np.array([len(v) for v in values], "<i4").tobytes(), np.stack(codes).astype("<u2").tobytes()
    )
    centres = rng.integers(-50, 50, (5, 4))
    want = ((rows[:, None] - centres[None]) ** 2).sum(2)
    of, distance = block.nearest(centres)
    assert (of == want.argmin(1)).all() and (distance == want.min(1)).all()
    assert (block.sums(of, 5) == np.array([rows[of == c].sum(0) for c in range(5)])).all()

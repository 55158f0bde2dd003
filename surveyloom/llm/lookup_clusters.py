"""Centroid clustering of integer vectors by scalar lookup tables.

Vectors are stored once as blocks that spell every dimension as the list of the
integers occurring in it and a small code for each vector. A round tabulates,
for each dimension, occurring integer and centroid, the squared difference;
distances are gathered from the tables by the codes and summed. All numbers are
whole, so results do not depend on the order of rows or on the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.session import ship_package, store

# Vectors in a block; codes of 16 bits tell its integers apart.
BLOCK = 4096
# Scaled components beyond take no part: their squared distances would not fit 64 bits with certainty.
LARGEST = 1 << 27
WHOLE = "decimal(38,0)"


def whole_vectors(df: DataFrame, ident: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(ident, whole): ``floor(scale * x)`` of each component, of the vectors that take part."""
    parts = F.transform(F.col("vector"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / scale))
    return (
        df.select(F.col(ident).alias("ident"), F.col(vector).alias("vector"))
        .where((F.size("vector") == dims) & F.coalesce(finite, F.lit(False)))
        .select("ident", parts.alias("whole"))
    )


def blocks_of(vectors: DataFrame, dims: int) -> DataFrame:
    """(idents, values, sizes, codes): up to ``BLOCK`` vectors of one task, each dimension as a list of integers and codes."""
    kind = vectors.schema["ident"].dataType.simpleString()

    def emit(idents: list[pa.Array], found: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(found)
        values, codes = zip(*(np.unique(rows[:, d], return_inverse=True) for d in range(dims)))
        ident = pa.concat_arrays(idents)
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(ident)], pa.int32()), ident),
                pa.array([np.concatenate(values).astype("<i8").tobytes()]),
                pa.array([np.array([len(v) for v in values], "<i4").tobytes()]),
                pa.array([np.stack(codes).astype("<u2").tobytes()]),
            ],
            ["idents", "values", "sizes", "codes"],
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idents, found, held = [], [], 0
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            first = 0
            while first < len(rows):
                last = min(len(rows), first + BLOCK - held)
                idents.append(batch.column(0).slice(first, last - first))
                found.append(rows[first:last])
                held += last - first
                first = last
                if held == BLOCK:
                    yield emit(idents, found)
                    idents, found, held = [], [], 0
        if held:
            yield emit(idents, found)

    schema = f"idents array<{kind}>, values binary, sizes binary, codes binary"
    return vectors.select("ident", "whole").mapInArrow(gather, schema)


class Block:
    """A block's tables: occurring integers and codes by dimension."""

    def __init__(self, values: bytes, sizes: bytes, codes: bytes):
        counts = np.frombuffer(sizes, "<i4")
        self.values = np.split(np.frombuffer(values, "<i8"), np.cumsum(counts)[:-1])
        self.codes = np.frombuffer(codes, "<u2").reshape(len(counts), -1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid, of equally near ones the first, and the squared distance to it."""
        sums = np.zeros((self.codes.shape[1], len(centroids)), np.int64)
        for values, codes, centre in zip(self.values, self.codes, centroids.T):
            table = (values[:, None] - centre[None, :]) ** 2
            sums += table[codes]
        cluster = sums.argmin(1)
        return cluster, sums[np.arange(len(cluster)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of the vectors of each cluster: how often each integer occurs in it, times the integer."""
        out = np.zeros((k, len(self.values)), np.int64)
        for d, (values, codes) in enumerate(zip(self.values, self.codes)):
            times = np.bincount(cluster * len(values) + codes, minlength=k * len(values)).reshape(k, -1)
            out[:, d] = times @ values
        return out


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Block]]:
    lists, raw = batch.column(0), [c.to_pylist() for c in batch.columns[1:]]
    for i, row in enumerate(zip(*raw)):
        yield lists[i].values, Block(*row)


def cluster(
    df: DataFrame, k: int, rounds: int, start: Column, ident: str = "vec_id", vector: str = "embedding",
    dims: int = 64, scale: int = 1024,
) -> tuple[DataFrame, list[list[int]]]:
    """((ident, cluster, distance, cluster_inertia, inertia) of each vector, the centroids).

    Takes the vectors with exactly ``dims`` components, none null or non-finite
    (nor beyond ``LARGEST`` when scaled), as ``floor(scale * x)``. The centroids
    start as the ``k`` vectors first in the order of ``start``, a column over
    ``ident`` (nulls last; ties by the vector), fewer if there are fewer. Each of
    ``rounds`` rounds assigns every vector to the nearest centroid and moves
    every centroid that has vectors to the floor of their mean; then vectors are
    assigned once more. ``distance`` is squared, ``cluster_inertia`` and
    ``inertia`` are its sums.

    Null ids and repeated rows are vectors like any other; without vectors there
    are no rows and no centroids. Other columns are not looked at.

    Only centroids and, for each cluster, its sums come to the driver. Tasks
    send one row for each cluster and dimension, whatever they hold.
    """
    spark = df.sparkSession
    ship_package(spark)
    vectors = whole_vectors(df, ident, vector, dims, scale)
    # `start` is written over the caller's id column, so it is computed before the column is renamed.
    first = (
        vectors.withColumnRenamed("ident", ident).select(start.alias("start"), "whole")
        .orderBy(F.col("start").asc_nulls_last(), "whole").limit(k).collect()
    )
    centroids = np.array([r["whole"] for r in first], np.int64).reshape(len(first), dims)
    stored = store(blocks_of(vectors, dims), "blocks")

    def sums_for(centres: np.ndarray) -> DataFrame:
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Whole numbers of any size: a task may hold any number of blocks.
            counts, sums = [0] * len(centres), [[0] * dims for _ in centres]
            for batch in batches:
                for _, block in _blocks(batch):
                    of, _ = block.nearest(centres)
                    for c, (n, row) in enumerate(zip(np.bincount(of, minlength=len(centres)), block.sums(of, len(centres)))):
                        counts[c] += int(n)
                        sums[c] = [a + b for a, b in zip(sums[c], row.tolist())]
            rows = [(c, d, counts[c], sums[c][d]) for c in range(len(centres)) if counts[c] for d in range(dims)]
            if rows:
                cluster, dim, n, total = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cluster, pa.int32()), pa.array(dim, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.int64())],
                    ["cluster", "dim", "n", "total"],
                )

        sent = stored.mapInArrow(over, "cluster int, dim int, n long, total long")
        return sent.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast(WHOLE)).alias("total"))

    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for r in sums_for(centroids).collect():
            moved[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
        if np.array_equal(moved, centroids):
            break  # every later round would repeat this one
        centroids = moved

    kind = vectors.schema["ident"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for idents, block in _blocks(batch):
                of, distance = block.nearest(centroids)
                yield pa.RecordBatch.from_arrays(
                    [idents, pa.array(of, pa.int32()), pa.array(distance, pa.int64())], ["ident", "cluster", "distance"]
                )

    assigned = stored.mapInArrow(assign, f"ident {kind}, cluster int, distance long")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast(WHOLE)).alias("sum")).collect()
    # One entry for each of the k clusters.
    inertia = spark.createDataFrame(
        [(r["cluster"], int(r["sum"]), sum(int(s["sum"]) for s in sums)) for r in sums], "cluster int, cluster_inertia long, inertia long"
    )
    out = assigned.join(F.broadcast(inertia), "cluster").select(
        F.col("ident").alias(ident), "cluster", "distance", "cluster_inertia", "inertia"
    )
    return out, centroids.tolist()

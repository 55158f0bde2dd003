"""Approximate nearest neighbours: a forest of random-projection trees, searched best margin first, reranked exactly."""

from __future__ import annotations

from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches
from surveyloom.session import ship_package, store

# The trees are fitted on so many distinct vectors at most; all are indexed.
SAMPLE = 20_000
TREES = 4
# Vectors a leaf should hold, and the sampled ones it needs at least.
LEAF, LEAF_SAMPLE = 256, 32
# Vectors, and queries, of a leaf that one task compares; larger leaves are compared block by block.
BLOCK = 8192
# Share of the sample's nearest neighbours that the search must find, and queries it is tried with.
RECALL, TRIED = 0.95, 256
# Scores this close are compared exactly.
CLOSE = 1e-9


def vectors_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, summed the same way wherever the rows stand."""
    return np.clip((unit(a) * unit(b)).sum(axis=1), -1.0, 1.0)


class Forest:
    """Trees of median splits between two random points each; leaves are numbered over all trees."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.rng = np.random.default_rng(0)
        self.normals, self.cuts, self.children, self.roots = [], [], [], []
        self.share: list[float] = []  # of the rows, by leaf
        most = max(1, min(leaves, len(sample) // LEAF_SAMPLE))
        self.total = max(1, len(sample))
        for _ in range(TREES):
            self.roots.append(self._grow(sample, most))
        self.normals = np.array(self.normals) if self.normals else np.zeros((0, sample.shape[1]))
        self.cuts = np.array(self.cuts)
        self.effort = 1.0 * TREES

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        if leaves > 1 and len(points) > 1:
            for _ in range(3):
                a, b = points[self.rng.choice(len(points), 2, replace=False)]
                if np.array_equal(a, b):
                    continue
                along = points @ (a - b)
                cut = float(np.median(along))
                left = along < cut
                if 0 < left.sum() < len(points):
                    node = len(self.cuts)
                    self.normals.append((a - b) / np.linalg.norm(a - b))
                    self.cuts.append(cut / np.linalg.norm(a - b))
                    self.children.append(None)
                    self.children[node] = (
                        self._grow(points[left], leaves // 2), self._grow(points[~left], leaves - leaves // 2)
                    )
                    return node
        self.share.append(len(points) / self.total)
        return -len(self.share)

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.normals.T - self.cuts

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        margins, out = self.margins(vectors), np.zeros((len(vectors), TREES), np.int64)
        for tree, root in enumerate(self.roots):
            waiting = [(root, np.arange(len(vectors)))]
            while waiting:
                node, rows = waiting.pop()
                if node < 0:
                    out[rows, tree] = -node - 1
                    continue
                right = margins[rows, node] >= 0
                waiting += [(self.children[node][0], rows[~right]), (self.children[node][1], rows[right])]
        return out

    def visits(self, margins: np.ndarray, effort: float) -> list[int]:
        """Leaves for one query in the order of a queue that all trees share, until they hold ``effort`` of the rows."""
        queue = [(0.0, 0.0, root) for root in self.roots]
        found, seen = [], 0.0
        while queue and (seen < effort or not found):
            far, _, node = heappop(queue)
            if node < 0:
                found.append(-node - 1)
                seen += self.share[-node - 1]
                continue
            margin = margins[node]
            for side, child in ((-margin, self.children[node][0]), (margin, self.children[node][1])):
                # A node is as far as the splits on the way to it whose other side the query is on, squared and summed;
                # of equally far ones the one whose split is clearest comes first.
                heappush(queue, (far + min(0.0, side) ** 2, -abs(margin) if side > 0 else abs(margin), child))
        return found

    def calibrate(self, sample: np.ndarray, k: int) -> None:
        """Set the effort that finds ``RECALL`` of the sample's own nearest neighbours."""
        if len(self.share) <= TREES or len(sample) <= k + 1:
            return
        tried = sample[self.rng.choice(len(sample), min(TRIED, len(sample)), replace=False)]
        near = np.argsort(-(tried @ sample.T), axis=1, kind="stable")[:, : k + 1]
        leaves, margins = self.leaves(sample), self.margins(tried)
        needed = []
        for row in range(len(tried)):
            order = self.visits(margins[row], np.inf)
            held = np.full(len(self.share), np.inf)
            held[order] = np.cumsum([self.share[i] for i in order])
            needed += held[leaves[near[row]]].min(axis=1).tolist()
        self.effort = float(np.quantile(needed, RECALL)) + 1e-9


def usable(vector: str) -> Column:
    v = F.col(vector)
    return (
        F.coalesce(
            ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0),
            F.lit(False),
        )
    )


def nearest(
    df: DataFrame, is_query: Column, k: int = 5, ident: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, ident, score): for each query row the ``k`` other rows of largest cosine that were found.

    All rows are indexed and are candidates. Equal scores go by the smaller id.
    Each distinct vector is searched for once and takes part once, with its
    ``k + 1`` smallest ids: no more of them can be among the nearest. How many
    leaves a query visits is decided on the sample, where the share ``RECALL`` of
    the true neighbours has to be found.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without an id. Vectors of different lengths have no cosine:
    each length has its own forest. Fewer than ``k`` candidates give fewer rows,
    an empty table none. Rows with the same id and vector count once; rows with
    the same id and different vectors are different candidates, and each of them
    that asks has its own ranks.
    """
    ship_package(df.sparkSession)
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    valid = df.where(usable(vector) & F.col(ident).isNotNull()).select(
        F.col(ident).alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v"), is_query.alias("asks")
    )
    lengths = [r[0] for r in valid.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    found = [_nearest(valid.where(F.size("v") == n), k) for n in lengths or [0]]
    return reduce(DataFrame.unionByName, found).select("query_id", "rank", F.col("id").alias(ident), "score")


def _nearest(valid: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) among (id, v, asks) of one length."""
    spark = valid.sparkSession
    numbers = valid.schema["v"].dataType.simpleString()
    # The smallest ids of each distinct vector; the limit applies before the shuffle.
    place = Window.partitionBy("v").orderBy("id")
    smallest = valid.groupBy("v", "id").agg(F.max("asks").alias("asks")).withColumn("place", F.row_number().over(place))
    groups = (
        smallest.where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        # A vector's own number, as ids may repeat; written down before it is used.
        .withColumn("key", F.monotonically_increasing_id())
    )
    groups = store(groups, "vectors")
    asking = valid.where("asks").select("id", "v").distinct()
    # By (id, vector) unique: the key of a query's vector.
    queries = store(asking.join(groups.select("v", "key"), "v").select("id", "key"), "queries")
    count = groups.count()
    sampled = groups.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").toArrow()
    sample = unit(vectors_of(sampled.column(0))) if sampled.num_rows else np.zeros((0, 1))
    forest = Forest(sample, -(-count // LEAF))
    forest.calibrate(sample, k)
    # Bounded by the sample: at most its rows / LEAF_SAMPLE splits in each tree.
    shared = spark.sparkContext.broadcast(forest)

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaves = shared.value.leaves(unit(vectors_of(batch.column(2))))
        rows = pa.array(np.repeat(np.arange(len(leaves)), leaves.shape[1]))
        return pa.RecordBatch.from_arrays(
            [pa.array(leaves.reshape(-1)), *(batch.column(i).take(rows) for i in range(3))], ["leaf", "key", "ids", "v"]
        )

    def count_leaves(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaves = shared.value.leaves(unit(vectors_of(batch.column(0))))
        return pa.RecordBatch.from_arrays([pa.array(leaves.reshape(-1))], ["leaf"])

    def ask(batch: pa.RecordBatch) -> pa.RecordBatch:
        margins = shared.value.margins(unit(vectors_of(batch.column(1))))
        visits = [shared.value.visits(m, shared.value.effort) for m in margins]
        rows = pa.array(np.repeat(np.arange(len(visits)), [len(v) for v in visits]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(visits).astype(np.int64)), *(batch.column(i).take(rows) for i in range(2))],
            ["leaf", "key", "v"],
        )

    kind = valid.schema["id"].dataType.simpleString()
    indexed = map_batches(groups.select("key", "ids", "v"), index, f"leaf long, key long, ids array<{kind}>, v {numbers}")
    asked = map_batches(
        groups.join(queries.select("key").distinct(), "key", "left_semi").select("key", "v"), ask,
        f"leaf long, key long, v {numbers}",
    )
    asked = store(asked, "asked")
    # A leaf's vectors and queries in blocks; every block of the one meets every block of the other.
    sizes = map_batches(groups.select("v"), count_leaves, "leaf long")
    vector_blocks = sizes.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("vs"))
    query_blocks = asked.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("qs"))
    blocks = store(vector_blocks.join(query_blocks, "leaf"), "blocks")

    def upto(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("key"), F.col(n)).cast("int")

    left = indexed.join(blocks, "leaf").select("leaf", own("vs").alias("i"), upto("qs").alias("j"), "key", "ids", "v")
    right = asked.join(blocks, "leaf").select("leaf", upto("vs").alias("i"), own("qs").alias("j"), "key", "v")

    def rerank(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not candidates.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("query", queries.schema.field("key").type), ("key", candidates.schema.field("key").type), ("ids", candidates.schema.field("ids").type), ("score", pa.float64()))})
        a, b = vectors_of(candidates.column("v")), vectors_of(queries.column("v"))
        ua, ub = unit(a), unit(b)
        # Equal scores go by the smaller id.
        firsts = candidates.column("ids").combine_chunks()
        order = pc.sort_indices(pa.table({"id": pc.list_element(firsts, 0), "key": candidates.column("key")}), [("id", "ascending"), ("key", "ascending")])
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        chosen, askers, scores = [], [], []
        for first in range(0, len(ub), 256):
            near = ub[first : first + 256] @ ua.T
            least = np.partition(near, -min(k + 1, len(ua)), axis=1)[:, -min(k + 1, len(ua))]
            for row, scored in enumerate(near):
                at = np.nonzero(scored >= least[row] - CLOSE)[0]
                exact = cosine(np.broadcast_to(b[first + row], (len(at), b.shape[1])), a[at])
                best = np.lexsort((rank[at], -exact))[: k + 1]
                chosen.append(at[best])
                askers.append(np.full(len(best), first + row))
                scores.append(exact[best])
        rows, asker = pa.array(np.concatenate(chosen)), pa.array(np.concatenate(askers))
        return pa.table({
            "query": queries.column("key").take(asker), "key": candidates.column("key").take(rows),
            "ids": candidates.column("ids").take(rows), "score": pa.array(np.concatenate(scores)),
        })

    pairs = left.groupBy("leaf", "i", "j").cogroup(right.groupBy("leaf", "i", "j")).applyInArrow(
        rerank, f"query long, key long, ids array<{kind}>, score double"
    )
    top = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0], "key")
    best = (
        pairs.groupBy("query", "key").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
        .withColumn("place", F.row_number().over(top))
        .where(F.col("place") <= k + 1)
    )
    by_query = Window.partitionBy("query_id", "asker").orderBy(F.desc("score"), "id", "key")
    return (
        queries.select(F.col("id").alias("query_id"), F.col("key").alias("asker"))
        .join(best.select(F.col("query").alias("asker"), "key", "score", F.explode("ids").alias("id")), "asker")
        .where("id <> query_id OR key <> asker")
        .withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )

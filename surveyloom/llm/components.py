"""Connected components of a graph of long ids, as Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.session import store


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` points reaches over the links ``a[i]``-``b[i]``."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, shorter := root[root]):
            root = shorter


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node reached.

    Alternates the large-star and small-star steps: each is a minimum per node,
    combined before its shuffle, and an equi-join that may be split where a node
    has many links. Links never multiply; the number of rounds grows with the
    logarithm of the longest path. Each round's links are stored, so that a lost
    executor costs one round at most. Self-links give a node of its own; no
    links give no rows.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    stars = store(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        both = stars.select("a", "b").unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(lower.select("a", F.col("m").alias("b")))
            .distinct()
        )
        stars = store(small, "links")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return nodes.join(stars.withColumnsRenamed({"a": "node", "b": "root"}), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )

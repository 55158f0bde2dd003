"""SimHash near-duplicates, found exactly by vantage-point trees."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches, utf8
from surveyloom.llm.components import connected, spanning
from surveyloom.llm.simhash import text_fingerprint
from surveyloom.session import ship_package, store

# The tree that deals fingerprints to shards is fitted on so many of them at most.
SAMPLE = 1 << 18
# Fewer than so many fingerprints, with more than this part of all rows each, are joined by broadcast.
HOT = 1000
# Fingerprints a shard should hold, and the sampled ones it needs at least.
SHARD = 1 << 14
SHARD_SAMPLE = 16
# Rows of a shard that one task compares with each other; larger shards are compared block by block.
BLOCK = 1 << 18
# Inside a task, cells of at most so many fingerprints are compared directly.
CELL = 512


def fingerprints(df: DataFrame, ident: str, text: str, length: int) -> DataFrame:
    """(ident, fp): the fingerprint of each text as a signed long, repeated rows kept.

    Null and empty texts have fingerprint 0.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([text_fingerprint(t, length) for t in utf8(batch.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["ident", "fp"])

    kind = df.schema[ident].dataType.simpleString()
    return map_batches(df.select(F.col(ident).alias("ident"), F.col(text).alias("text")), one, f"ident {kind}, fp long")


def distances(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


class Tree:
    """A vantage-point tree over a sample: node i has a point and a radius; leaves are numbered."""

    def __init__(self, sample: np.ndarray, leaves: int, least: int):
        self.nodes: list[tuple] = []
        self.leaves = 0
        self.rng = np.random.default_rng(0)
        self.root = self._grow(sample, max(1, leaves), max(2, least))

    def _grow(self, values: np.ndarray, leaves: int, least: int) -> int:
        if leaves > 1 and len(values) >= 2 * least and (cut := split(values, self.rng)):
            point, radius, near = cut
            node = len(self.nodes)
            self.nodes.append(())
            inside = self._grow(values[near], (leaves + 1) // 2, least)
            outside = self._grow(values[~near], leaves // 2, least)
            self.nodes[node] = (point, radius, inside, outside)
            return node
        self.leaves += 1
        return -self.leaves

    def deal(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, index, home): each value's own leaf, and the leaves whose boundary lies within ``radius``."""
        out = []
        index = np.arange(len(values))
        waiting = [(self.root, index, np.ones(len(values), bool))]
        while waiting:
            node, index, home = waiting.pop()
            if not len(index):
                continue
            if node < 0:
                out.append((np.full(len(index), -node), index, home))
                continue
            point, cut, inside, outside = self.nodes[node]
            near_index, near_home, far_index, far_home = part(values, index, home, point, cut, radius)
            waiting += [(inside, near_index, near_home), (outside, far_index, far_home)]
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (index, index, index.astype(bool))


def split(values: np.ndarray, rng: np.random.Generator) -> tuple | None:
    """A vantage point and a radius that part the values most evenly of a few tries; None if nothing parts them."""
    best = None
    for point in rng.choice(values, 4):
        d = distances(values, point)
        for cut in {int(np.median(d)), int(np.median(d)) - 1}:
            near = d <= cut
            even = min(near.sum(), (~near).sum())
            if even and (best is None or even > best[0]):
                best = (even, point, cut, near)
    return best and best[1:]


def part(values, index, home, point, cut, radius):
    """Send values inside or outside; pairs within ``radius`` meet in the part that is one's home.

    If a is inside and b outside, then d(b) <= d(a) + radius by the triangle
    inequality, so b visits the inside from within ``cut + radius``. Homes need
    no visit the other way; visitors look for homes on both sides.
    """
    d = distances(values[index], point)
    near = d <= cut
    in_near = near | (d <= cut + radius)
    in_far = ~near | (~home & (d > cut - radius))
    return index[in_near], (home & near)[in_near], index[in_far], (home & ~near)[in_far]


def links(values: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (index, index) that span every group of values joined by pairs within ``radius``.

    Every pair with at least one home is looked at or pruned by the triangle
    bound. Only spanning links come out, so a group of m gives at most m - 1.
    """
    rng = np.random.default_rng(0)
    root = np.arange(len(values))
    waiting = [(np.arange(len(values)), home)]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    pairs = 0
    while waiting:
        index, own = waiting.pop()
        homes = index[own]
        if not len(homes):
            continue
        if len(homes) > CELL and (cut := split(values[homes], rng)):
            point, middle, near = cut
            near_index, near_home, far_index, far_home = part(values, index, own, point, middle, radius)
            # A cut that sends nearly all to both sides does not help.
            if max(len(near_index), len(far_index)) <= 0.95 * len(index):
                waiting += [(near_index, near_home), (far_index, far_home)]
                continue
        for i in range(0, len(homes), CELL):
            rows = homes[i : i + CELL]
            for j in range(0, len(index), 1 << 13):
                columns = index[j : j + (1 << 13)]
                a, b = np.nonzero(np.bitwise_count(values[rows][:, None] ^ values[columns][None, :]) <= radius)
                a, b = rows[a], columns[b]
                apart = root[a] != root[b]
                found.append((a[apart], b[apart]))
                pairs += int(apart.sum())
                if pairs > 1 << 20:
                    root, found, pairs = merged(root, found), [], 0
    root = merged(root, found)
    linked = np.nonzero(root != np.arange(len(values)))[0]
    return linked, root[linked]


def merged(root: np.ndarray, found: list) -> np.ndarray:
    have = np.nonzero(root != np.arange(len(root)))[0]
    return spanning(
        len(root),
        np.concatenate([have, *(a for a, _ in found)]),
        np.concatenate([root[have], *(b for _, b in found)]),
    )


def linked_fingerprints(distinct: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that span every group of the distinct fingerprints ``fp`` joined by pairs within ``radius``.

    A tree fitted on a bounded sample deals every fingerprint to its shard and,
    as a visitor, to the shards whose boundary lies within the radius. A shard
    beyond ``BLOCK`` rows is compared as pairs of blocks, in as many tasks.
    """
    spark = distinct.sparkSession
    ship_package(spark)
    count = distinct.count()
    rows = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE, max(1024, count // 8))).toPandas()
    tree = Tree(rows["fp"].to_numpy(np.int64).view(np.uint64), -(-count // SHARD), SHARD_SAMPLE)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).to_numpy().view(np.uint64)
        leaf, index, home = tree.deal(values, radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(leaf.astype(np.int32)), pa.array(values[index].view(np.int64)), pa.array(home)],
            ["leaf", "fp", "home"],
        )

    dealt = store(map_batches(distinct.select("fp"), deal, "leaf int, fp long, home boolean"), "dealt")
    blocks = dealt.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = (
        dealt.join(blocks, "leaf")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", other)
        .select("leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp", "home")
    )

    def compare(table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        a, b = links(values, table.column("home").to_numpy(), radius)
        return pa.table({"a": values[a].view(np.int64), "b": values[b].view(np.int64)})

    return cells.groupBy("leaf", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(df: DataFrame, ident: str = "doc_id", text: str = "text", length: int = 3, radius: int = 2) -> DataFrame:
    """(ident, fingerprint, component_id) for every row of ``df``.

    Texts whose SimHash over shingles of ``length`` words differs in ``radius``
    bits or fewer are linked; ``component_id`` is the smallest id reachable over
    links. Each distinct fingerprint takes part once, so copies cost nothing,
    and links are spanning ones, so no group emits all its pairs.

    Null and empty texts have fingerprint 0 and are linked like any other;
    repeated rows come back repeated; rows with a null id come back with the
    component of their text (null where nothing in it has an id); an empty table
    gives no rows. Other columns are not looked at.
    """
    prints = store(fingerprints(df, ident, text, length), "fingerprints")
    distinct = store(prints.groupBy("fp").agg(F.min("ident").alias("first"), F.count("*").alias("rows")), "distinct")
    roots = store(connected(store(linked_fingerprints(distinct, radius), "pairs")), "roots")
    inside = distinct.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = inside.groupBy("root").agg(F.min("first").alias("component"))
    component = inside.join(least, "root").select("fp", "component")
    of = distinct.join(component, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id"), "rows")
    # Copies of one text would all meet in one task, so the commonest texts are looked up where their rows are:
    # at most HOT fingerprints have more than one row in HOT.
    many = max(HOT, (distinct.agg(F.sum("rows")).first()[0] or 0) // HOT)
    hot = F.broadcast(of.where(F.col("rows") > many).select("fp", F.col("component_id").alias("known"), F.lit(True).alias("hot")))
    looked = prints.join(hot, "fp", "left")
    rest = looked.where("hot is null").select("ident", "fp").join(of.select("fp", "component_id"), "fp")
    found = looked.where("hot").select("ident", "fp", F.col("known").alias("component_id")).unionByName(rest.select("ident", "fp", "component_id"))
    return found.select(
        F.col("ident").alias(ident), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

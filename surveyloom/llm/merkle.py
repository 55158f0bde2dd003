"""A Merkle manifest of a table: one tree for each group of rows, their roots under one more tree.

Leaves lie in aligned blocks of ``fanout ** levels`` consecutive ones. A block
builds its own part of the tree. Then blocks take part in a butterfly exchange:
in each round the blocks that differ in one digit of their number (to the base
``fanout``) swap the roots of the subtrees they stand in, and each hashes the
common ancestor itself. After the last round every block holds the group's root
and all siblings on its way up; nothing is sent back down.

Digests are lowercase hex SHA-256, of inputs concatenated as text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.session import ship_package, store

HEX = 64
# The siblings of a node at each level.
SIDES = "array<struct<left:array<string>, right:array<string>>>"
SIDES_KIND = pa.list_(pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]))


def digest(columns: Sequence[str | Column]) -> Column:
    """The digest of a row: of each column ``-`` if null, else the value's UTF-8 byte count, ``:`` and the value."""

    def spelled(column: str | Column) -> Column:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(spelled, columns)).cast("binary"), 256)


def hashed(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def height(leaves: int, fanout: int) -> int:
    """How many levels stand above the leaves of a tree."""
    levels, reach = 0, 1
    while reach < leaves:
        levels, reach = levels + 1, reach * fanout
    return levels


def levels_of(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes of each level of a block, leaves first; the last level is the block's root."""
    out = [leaves]
    for _ in range(levels):
        below = out[-1]
        out.append([hashed(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return out


def _numbered(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``leaves`` (g, key, leaf, now) with each leaf's number in its group from 0, and the group's size.

    Rows are sorted by range, so a group may lie in any number of tasks; a row's
    number is its place among the group's rows of its task plus those of earlier
    tasks. The sorted rows are stored with both, since counts and rows have to
    agree even when an executor is lost in between.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, following = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
            places = np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))
            if groups[0] == last:
                until = starts[1] if len(starts) > 1 else len(groups)
                places[:until] += following
            last, following = groups[-1], int(places[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(groups), part)), pa.array(places)], [*batch.schema.names, "part", "place"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in leaves.schema)
    order = [F.col("g"), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("now")]
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = store(ranged.mapInArrow(place, f"{kinds}, part long, place long"), "leaves")
    sizes = stored.groupBy("g", "part").agg(F.count("*").alias("size"))
    # One row for each task that has rows of the group, not for each row.
    group = Window.partitionBy("g")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "g", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"), F.sum("size").over(group).alias("total")
    )
    number = F.col("before") + F.col("place")
    return stored.join(before, ["g", "part"]).select(
        "g", "key", "leaf", "now", "total", number.alias("number"), F.floor(number / fanout**levels).cast("long").alias("block")
    )


def _blocks(numbered: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(g, block, total, keys, leaves, nows, top): one row for each aligned block of leaves, with its root."""
    kind = numbered.schema["key"].dataType.simpleString()

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("number")
        leaves = table.column("leaf").to_pylist()
        total = table.column("total")[0].as_py()
        top = levels_of(leaves, min(levels, height(total, fanout)), fanout)[-1][0]
        keys = table.column("key").combine_chunks()
        return pa.table({
            "g": table.column("g").slice(0, 1), "block": table.column("block").slice(0, 1), "total": table.column("total").slice(0, 1),
            "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            "leaves": pa.array([bytes.fromhex("".join(leaves))]),
            "nows": pa.array([bytes.fromhex("".join(table.column("now").to_pylist()))]),
            "top": pa.array([top]),
        })

    schema = f"g string, block long, total long, keys array<{kind}>, leaves binary, nows binary, top string"
    return numbered.groupBy("g", "block").applyInArrow(build, schema)


def _exchange(state: DataFrame, fanout: int, rounds: int) -> DataFrame:
    """(g, block, top, sides) after all rounds: ``top`` is the group's root, ``sides`` the siblings passed on the way.

    ``state`` has (g, block, blocks, top). In round r a block meets those whose
    numbers differ from its own in digit r alone, ``fanout`` at most. Where the
    last subtree is not full, its missing blocks are stood for by those it has,
    in turn: they send for them, but receive nothing.
    """
    state = state.withColumn("sides", F.lit(None).cast(SIDES)).withColumn("sides", F.coalesce("sides", F.array().cast(SIDES)))
    for r in range(rounds):
        width = fanout**r
        subtree = F.floor(F.col("block") / width).cast("long")
        last = F.floor((F.col("blocks") - 1) / width).cast("long")
        present = F.col("blocks") - last * width
        low = F.col("block") % width
        # The places in its subtree a block sends for: its own, and every so many after it in the last subtree.
        sent_for = F.when(
            (subtree == last) & (last % fanout > 0) & (present < width), F.sequence(low, F.lit(width - 1), present)
        ).otherwise(F.array(low))
        active = F.col("blocks") > width
        sent = state.where(active).select(
            "g", F.floor(subtree / fanout).cast("long").alias("above"), (subtree % fanout).alias("digit"), "block", "blocks",
            "top", "sides", low.alias("own"), F.explode(sent_for).alias("low"),
        )
        member = F.struct(
            "digit", "top", (F.col("own") == F.col("low")).alias("receives"), "block", "blocks", "sides"
        )
        # At most one member for each digit.
        met = sent.groupBy("g", "above", "low").agg(F.array_sort(F.collect_list(member), _by_digit).alias("members"))
        tops = met.select(
            "g", "members", F.sha2(F.array_join(F.transform("members", lambda m: m["top"]), "").cast("binary"), 256).alias("ancestor"),
            F.explode("members").alias("me"),
        ).where("me.receives")

        def others(smaller: bool) -> Column:
            side = F.filter("members", lambda m: m["digit"] < F.col("me.digit") if smaller else m["digit"] > F.col("me.digit"))
            return F.transform(side, lambda m: m["top"])

        passed = F.struct(others(True).alias("left"), others(False).alias("right"))
        moved = tops.select(
            "g", "me.block", "me.blocks", F.col("ancestor").alias("top"),
            F.concat("me.sides", F.array(passed)).cast(SIDES).alias("sides"),
        )
        state = moved.unionByName(state.where(~active))
        if r % 4 == 3:
            state = store(state, "exchanged")
    return state.select("g", "block", "top", "sides")


def _by_digit(a: Column, b: Column) -> Column:
    return F.when(a["digit"] < b["digit"], -1).when(a["digit"] > b["digit"], 1).otherwise(0)


def _forest(leaves: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """(blocks, uppers): the stored blocks of all groups, and (g, block, top, sides) with each group's root as ``top``."""
    blocks = store(_blocks(_numbered(leaves, fanout, levels), fanout, levels), "blocks")
    state = blocks.select("g", "block", F.ceil(F.col("total") / fanout**levels).cast("long").alias("blocks"), "top")
    most = state.agg(F.max("blocks")).first()[0] or 1
    return blocks, store(_exchange(state, fanout, height(most, fanout)), "uppers")


def proof_of(number: int, nodes: list[list[str]], fanout: int) -> list[tuple[list[str], list[str]]]:
    """(left, right) siblings of a leaf of a block at each level below the block's root."""
    sides = []
    for level in nodes[:-1]:
        first = number - number % fanout
        sides.append((level[first:number], level[number + 1 : first + fanout]))
        number //= fanout
    return sides


def fold(leaf: str, sides: Sequence[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its siblings, level by level, lead to."""
    for left, right in sides:
        leaf = hashed(*left, leaf, *right)
    return leaf


def manifest(
    df: DataFrame, group: str, key: str, leaf: str = "leaf", now: str = "leaf", fanout: int = 8, levels: int = 4,
    siblings: bool = False,
) -> DataFrame:
    """(group, key, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``df``.

    ``leaf`` holds each row's digest when the manifest is made (see
    :func:`digest`), ``now`` its digest at the time of checking. The leaves of
    each group ascend by ``key``; while more than one node is left, every
    ``fanout`` consecutive ones become their common digest, and what remains is
    the group's ``subroot``. The subroots, by group, lead to ``root`` likewise.
    ``proof_sha256`` is the digest of all siblings from the leaf up to the root,
    each level from left to right, and ``folded_root`` the root that ``now`` and
    these lead to. With ``siblings`` the proof comes too, as an array of (left,
    right) for each level.

    A null group and null keys come first; rows of one key ascend by their leaf,
    then by ``now``, so rows that repeat may change places and nothing else. A
    single row's proof is empty and its leaf is the root. An empty table gives
    no rows. Other columns are not looked at.

    A block of ``fanout ** levels`` leaves is one task's work at a time, whatever
    the size of its group.
    """
    ship_package(df.sparkSession)
    # Null groups first, the others in the order of their UTF-8 bytes.
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    leaves = df.select(g.alias("g"), F.col(key).alias("key"), F.col(leaf).alias("leaf"), F.col(now).alias("now"))
    blocks, uppers = _forest(leaves, fanout, levels)

    # The groups' roots are the leaves of one more tree.
    roots = uppers.where("block = 0").select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("top").alias("leaf"), F.col("top").alias("now"))
    top_blocks, top_uppers = _forest(roots, fanout, levels)
    over = _proofs(top_blocks.join(top_uppers.withColumnRenamed("top", "root"), ["g", "block"]), fanout, levels)
    above = over.select(F.col("key").alias("g"), F.col("sides").alias("over"), "root")

    kind = leaves.schema["key"].dataType.simpleString()
    # Narrow rows are joined first: one for each block.
    joined = blocks.join(
        uppers.join(above, "g").select(
            "g", "block", F.col("top").alias("subroot"), "root", F.concat("sides", "over").alias("sides")
        ),
        ["g", "block"],
    )

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = _nodes(row, fanout, levels)
                upper = [(s["left"], s["right"]) for s in row["sides"]]
                proofs = [proof_of(i, nodes, fanout) + upper for i in range(len(nodes[0]))]
                n = len(proofs)
                nows = row["nows"].hex()
                folded = [fold(nows[HEX * i : HEX * (i + 1)], p) for i, p in enumerate(proofs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["g"]] * n), pa.array(row["keys"], batch.schema.field("keys").type.value_type),
                        pa.array(nodes[0]), pa.array([row["subroot"]] * n), pa.array([row["root"]] * n),
                        pa.array([hashed(*(s for side in p for part in side for s in part)) for p in proofs]),
                        pa.array(folded), pa.array([f == row["root"] for f in folded]),
                        pa.array([[{"left": l, "right": r} for l, r in p] for p in proofs] if siblings else [None] * n, SIDES_KIND),
                    ],
                    ["g", "key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "siblings"],
                )

    made = joined.mapInArrow(
        unfold,
        f"g string, key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        f"verified boolean, siblings {SIDES}",
    )
    name = F.when(F.col("g") != "-", F.substr("g", F.lit(2))).cast(df.schema[group].dataType)
    kept = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["siblings"] if siblings else [])]
    return made.select(name.alias(group), F.col("key").alias(key), *kept)


def _nodes(row: dict, fanout: int, levels: int) -> list[list[str]]:
    """The nodes of a stored block, level by level."""
    raw = row["leaves"].hex()
    leaves = [raw[i : i + HEX] for i in range(0, len(raw), HEX)]
    return levels_of(leaves, min(levels, height(row["total"], fanout)), fanout)


def _proofs(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(key, root, sides) for each leaf of ``blocks`` joined to their uppers: all siblings up to the root."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = _nodes(row, fanout, levels)
                upper = [(s["left"], s["right"]) for s in row["sides"]]
                sides = [
                    [{"left": l, "right": r} for l, r in proof_of(i, nodes, fanout) + upper] for i in range(len(nodes[0]))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["keys"], pa.string()), pa.array([row["root"]] * len(sides)), pa.array(sides, SIDES_KIND)],
                    ["key", "root", "sides"],
                )

    return blocks.mapInArrow(unfold, f"key string, root string, sides {SIDES}")

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plain import odd_documents
from surveyloom.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fanout):
    """(root, siblings of each leaf as (left, right) by level) of one tree, level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, place in enumerate(at):
            first = place - place % fanout
            proofs[leaf].append((nodes[first:place], nodes[place + 1 : first + fanout]))
            at[leaf] = place // fanout
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], proofs


def plain(rows, fanout):
    """rows: (group, key, leaf, now) -> sorted (group, key, leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    trees = {g: climb([r[2] for r in groups[g]], fanout) for g in names}
    root, over = climb([trees[g][0] for g in names], fanout) if names else (None, [])
    out = []
    for g, above in zip(names, over):
        for r, proof in zip(groups[g], trees[g][1]):
            sides, folded = proof + above, r[3]
            for left, right in sides:
                folded = h(*left, folded, *right)
            out.append((g, r[1], r[2], trees[g][0], root, h(*(s for side in sides for part in side for s in part)), folded, folded == root))
    return sorted(out, key=str)


def made(frame, **more):
    return sorted((tuple(r) for r in merkle.manifest(frame, "lang", "doc_id", now="now", **more).collect()), key=str)


SCHEMA = "lang string, doc_id long, leaf string, now string"


@pytest.mark.parametrize("fanout, levels, sizes", [
    (8, 4, [1]), (8, 1, [1, 8, 9, 64, 65]), (2, 1, [1, 2, 3, 5, 17, 33, 100]), (3, 1, [1, 3, 4, 10, 27, 28, 82, 83, 245]),
    (2, 2, [37] * 9), (8, 1, [513 + 8]), (4, 1, [300, 1, 64, 17, 65]), (2, 1, [2] * 40),
])
def test_equals_level_by_level(spark, fanout, levels, sizes):
    rnd = random.Random(fanout * 100 + levels)
    rows = []
    for g, n in enumerate(sizes):
        for i in rnd.sample(range(10 * n), n):
            leaf = h(f"{g}/{i}")
            rows.append((f"l{g}" if g else None, i, leaf, leaf if rnd.random() < 0.7 else h("other")))
    rnd.shuffle(rows)
    assert made(spark.createDataFrame(rows, SCHEMA), fanout=fanout, levels=levels) == plain(rows, fanout)


def test_groups_in_byte_order_null_ids_and_repeated_rows(spark):
    rows = [(g, i, h(str(i)), h(str(i))) for g in (None, "", "-", "=", "Z", "a", "é", "\U0001f600", "￿") for i in (None, None, 1, 1, 2)]
    rows += [("a", 1, h("x"), h("y")), ("a", 1, h("x"), h("z"))]
    frame = spark.createDataFrame([(*r, "k", "p") for r in rows], SCHEMA + ", key string, g string")
    for fanout in (2, 8):
        assert made(frame, fanout=fanout, levels=1) == plain(rows, fanout)
    assert made(spark.createDataFrame([], SCHEMA)) == []


def test_digests_spell_nulls_and_byte_counts(spark):
    rows = [(1, "s", "en", 3, "äb"), (None, None, None, None, None), (2, "", "-", -5, "1:x")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert [r[0] for r in frame.select(merkle.digest(COLUMNS)).collect()] == [leaf_of(r) for r in rows]


def test_siblings_fold_to_the_root_and_tampering_shows(spark):
    rows = [(g, i, h(g, str(i)), h(g, str(i)) if i % 3 else h("other")) for g in ("a", "b", "c") for i in range(70)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), "lang", "doc_id", now="now", fanout=4, levels=1, siblings=True).collect()
    assert len(got) == 210
    for r in got:
        sides = [(s["left"], s["right"]) for s in r["siblings"]]
        assert merkle.fold(r["leaf"], sides) == r["root"]
        assert r["verified"] == (r["doc_id"] % 3 > 0) == (r["folded_root"] == r["root"])


def test_a_group_over_many_tasks_keeps_its_numbers(spark):
    rows = [("hot" if i % 10 else "cold", i, h(str(i)), h(str(i))) for i in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(16)
    assert made(frame, fanout=8, levels=2) == plain(rows, 8)


def test_whole_odd_documents(spark):
    frame = odd_documents(spark).select(
        "doc_id", F.col("chunk").alias("lang"), merkle.digest(["doc_id", "text"]).alias("leaf"), "key", "place"
    )
    got = merkle.manifest(frame, "lang", "doc_id").collect()
    assert len(got) == frame.count() and all(r["verified"] for r in got)
    assert len({r["root"] for r in got}) == 1

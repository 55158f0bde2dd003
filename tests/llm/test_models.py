import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain import ODD, corpus, odd_documents, spaced
from surveyloom.llm import chunks, language_model, neighbours, trie
from surveyloom.llm.trie import EliasFano, Trie


def test_packed_runs():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 20, 50)
    values = rng.integers(0, 2 ** rng.integers(1, 40, lengths.sum()))
    packed = chunks.pack_runs(values, lengths)
    assert packed == [chunks.pack_ints(v) for v in np.split(values, np.cumsum(lengths)[:-1])]
    back, found = chunks.unpack_runs(packed)
    assert (back == values).all() and (found == lengths).all()
    assert chunks.pack_runs(values[:0], np.array([0, 0])) == [b"", b""]


def test_few_and_many_queries_of_a_trie_agree(monkeypatch):
    rng = np.random.default_rng(3)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 300, 3000), rng.integers(0, 40, 3000))})
    context, token = map(np.array, zip(*pairs))
    tree = trie.Trie.build(context, token, rng.integers(1, 60_000, len(pairs)).astype(np.uint16))
    asked = rng.integers(0, 310, 5000), rng.integers(0, 45, 5000)
    many = tree.find(*asked)
    monkeypatch.setattr(trie, "FEW", 0)
    assert (tree.find(*asked) == many).all() and (many > 0).sum() > 500


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**62])
    assert (chunks.unpack_ints(chunks.pack_ints(values)) == values).all()
    assert (chunks.unpack_rising(chunks.pack_rising(values)) == values).all()
    assert not len(chunks.unpack_ints(chunks.pack_ints(values[:0])))


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (1, 10**9), (1000, 50), (5000, 10**12)])
def test_elias_fano(n, most):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, most, n)).astype(np.uint64)
    coded = EliasFano.build(values)
    assert (coded.get(np.arange(n)) == values).all() and (coded.all() == values).all()
    wanted = rng.integers(0, most + 1, 200).astype(np.uint64)
    low = rng.integers(0, n + 1, 200)
    high = np.maximum(low, rng.integers(0, n + 1, 200))
    want = [a + np.searchsorted(values[a:b], w) for a, b, w in zip(low, high, wanted)]
    assert coded.successor(low, high, wanted).tolist() == want


def test_trie_from_a_memory_mapped_file(tmp_path):
    rng = np.random.default_rng(2)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 500, 4000) * 3, rng.zipf(1.3, 4000) % 10_000)})
    context, token = map(np.array, zip(*pairs))
    codes = rng.integers(1, 60_000, len(pairs)).astype(np.uint16)
    (tmp_path / "trie").write_bytes(Trie.build(context, token, codes).to_bytes())
    mapped = Trie.view(np.memmap(tmp_path / "trie", np.uint8, "r"))
    asked = np.concatenate([context, rng.integers(0, 2000, 5000)]), np.concatenate([token, rng.zipf(1.3, 5000) % 10_000])
    held = dict(zip(pairs, codes.tolist()))
    assert mapped.find(*asked).tolist() == [held.get(p, 0) for p in zip(*map(np.ndarray.tolist, asked))]


def check_scores(rows, trains, got, discount=language_model.DISCOUNT):
    texts = [[*spaced(t), b"\n"] for _, t in rows]
    count = Counter(w for t, y in zip(texts, trains) if y for w in t)
    pairs = Counter(p for t, y in zip(texts, trains) if y for p in zip([b"\n", *t], t))
    kinds = Counter(v for v, _ in pairs)
    total, distinct = sum(count.values()), len(count)

    def single(w):
        return (count[w] + 0.5) / (total + 0.5 * (distinct + 1))

    want = []
    for (i, _), t in zip(rows, texts):
        base = sum(math.log10(single(w)) for w in t)
        full = sum(
            math.log10((max(pairs[v, w] - discount, 0) + discount * kinds[v] * single(w)) / count[v]) if count[v] else math.log10(single(w))
            for v, w in zip([b"\n", *t], t)
        )
        want.append((i, len(t), sum(count[w] > 0 for w in t), total, base, full))
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=str)
    for a, b in zip(got, sorted(want, key=str), strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6
        assert -(language_model.STEP * a[1]) - 1e-6 <= a[5] - b[5] <= 1e-6


def test_scores_equal_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(chunks, "TEXT_BYTES", 20_000)
    rows = corpus(150) + ODD[2:]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, levels = language_model.score(frame, F.col("doc_id") % 3 > 0, levels=True)
    check_scores(rows, [i % 3 > 0 for i, _ in rows], got.collect())
    assert sum(len(Trie.view(r["trie"]).codes) for r in levels.collect()) == len(
        {p for i, t in rows if i % 3 for p in zip([b"\n", *spaced(t), b"\n"], [*spaced(t), b"\n"])}
    )


def test_a_spread_context_counts_the_kinds_of_all_its_buckets(spark):
    rnd = random.Random(4)
    # Every other word is the same one, and a great many different ones follow it.
    rows = [(i, " ".join(f"the w{rnd.randrange(3000)}" for _ in range(300))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert (language_model.spread_of(np.array([12_000]), 10, 24_040) > 1).all()
    check_scores(rows, [i % 4 > 0 for i, _ in rows], language_model.score(frame, F.col("doc_id") % 4 > 0).collect())


def test_probabilities_of_a_context_add_up_to_one_at_most(spark):
    rows = [(i, "a b a c a b") for i in range(5)] + [(9, "c a"), (10, "b"), (11, "a unseen")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in language_model.score(frame, F.col("doc_id") < 5).collect()}
    check_scores(rows, [i < 5 for i, _ in rows], language_model.score(frame, F.col("doc_id") < 5).collect())
    assert 10 ** got[10] < 1


def test_no_training_and_odd_rows(spark):
    got = language_model.score(odd_documents(spark), F.lit(False)).collect()
    assert len(got) == 11 and all(r["base_score"] == r["score"] == 0 and r["n_known"] == 0 for r in got)
    assert len(language_model.score(odd_documents(spark), F.col("doc_id") > 0).collect()) == 11
    assert language_model.score(odd_documents(spark, []), F.lit(True)).count() == 0


def brute(rows, k=5):
    out = {}
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    for q, v in usable:
        if q % 5:
            continue
        scored = [(-float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), i) for i, w in usable if i != q]
        out[q] = sorted((round(s, 9), i) for s, i in scored)[:k]
    return out


def test_small_tables_are_exact_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(20)] + [(200, [0.0] * 8), (201, None), (202, [float("nan")] * 8), (None, rows[0][1])]
    rows += [(203, [None, *[1.0] * 7]), (205, [float("inf"), *[1.0] * 7]), (210, [1.0] * 3), (215, [1e200] * 8), (220, [])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, key string")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 5 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((round(-r["score"], 9), r["vec_id"]))
    want = brute([r for r in rows if r[0] != 215])
    assert 215 in got
    assert {q: [s for s, _ in v] for q, v in got.items() if q != 215 and 215 not in [i for _, i in v]} == {
        q: [s for s, _ in v] for q, v in want.items() if 215 not in [i for _, i in got[q]]
    }
    # The copies of row 3 come by their ids.
    assert [i for s, i in got[100]] == [3, 101, 102, 103, 104]
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(frame.where("vec_id = 5"), F.lit(True)).count() == 0


def test_repeated_ids_and_vectors_of_two_lengths(spark):
    one, two = [1.0, 0.0, 0.2], [0.0, 1.0, 0.1]
    rows = [(50, one), (50, two), (1, [0.9, 0.1, 0.2]), (2, [0.1, 0.9, 0.1]), (3, [0.5, 0.5, 0.0]), (4, [1.0, 1.0]), (100, [1.0, 0.0]), (150, [1.0] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(frame, F.col("vec_id") % 50 == 0, k=10).collect()
    fifty = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 50)
    # Each of the two rows ranks all others, the one of its own id included.
    assert fifty == sorted([(1, 1), (2, 3), (3, 2), (4, 50), (1, 2), (2, 3), (3, 1), (4, 50)])
    assert [(r["vec_id"], round(r["score"], 6)) for r in got if r["query_id"] == 100] == [(4, round(0.5**0.5, 6))]
    assert not [r for r in got if r["query_id"] == 150]


def test_recall_over_several_leaves(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 64)
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8))
    rows = [(i, (centres[i % 20] + 0.4 * rng.normal(size=8)).tolist()) for i in range(2000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = {q: {i for _, i in v} for q, v in brute(rows).items() if q % 50 == 0}
    assert sum(len(got[q] & v) for q, v in want.items()) >= 0.9 * 5 * len(want)

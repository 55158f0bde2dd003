import random

import pytest

from plain import corpus, odd_documents
from surveyloom.llm import toxicity


def plain_segments(weights):
    """The best stretch, shortest and first of equal ones, then the same to its left and right."""
    best = None
    for i in range(len(weights)):
        for j in range(i + 1, len(weights) + 1):
            s = sum(weights[i:j])
            if s > 0 and (best is None or s > best[0] + 1e-12):
                best = (s, i, j)
    if not best:
        return []
    s, i, j = best
    return plain_segments(weights[:i]) + [(i, j, s)] + [(a + j, b + j, t) for a, b, t in plain_segments(weights[j:])]


def test_segments_equal_the_recursive_definition():
    rnd = random.Random(5)
    for _ in range(200):
        weights = [rnd.choice([0, 0, 0, rnd.random() * 3]) for _ in range(rnd.randint(0, 40))]
        drift = -0.4
        words = [str(i).encode() for i in range(len(weights))]
        memo = toxicity.Memo(lambda w: weights[int(w)])
        got = toxicity.segments(words, memo, drift)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments([w or drift for w in weights])]


@pytest.fixture(scope="module")
def learnt(spark):
    rnd = random.Random(1)
    rows, labels = corpus(400, words=120), []
    for i, (ident, text) in enumerate(rows):
        bad = i % 6 == 0
        if bad:
            words = text.split()
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(["idiotic", "vileness", "Grubby"]) + rnd.choice(["", "s", "ly"]))
            rows[i] = (ident, " ".join(words))
        else:
            rows[i] = (ident, text + f" only{ident}")
        labels.append((ident, int(bad)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    train = spark.createDataFrame([x for x in labels if x[0] % 2] + [x for x in labels if x[0] % 12 == 0] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return documents, dict(labels), toxicity.fit(documents, train)


def test_held_out_accuracy(learnt):
    documents, labels, model = learnt
    rows = toxicity.score(documents, model).collect()
    wrong = [r["doc_id"] for r in rows if r["predicted"] != labels[r["doc_id"]] and r["doc_id"] % 2 == 0 and r["doc_id"] % 12]
    assert len(rows) == 400 and len(wrong) <= 4
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.keep_clean(documents, model).count() == sum(r["predicted"] == 0 for r in rows)


def test_odd_rows(spark, learnt):
    _, _, model = learnt
    got = toxicity.score(odd_documents(spark), model).collect()
    assert len(got) == 11 and not any(r["predicted"] for r in got)
    kept = toxicity.keep_clean(odd_documents(spark), model)
    assert kept.columns == odd_documents(spark).columns and kept.count() == 11
    assert toxicity.score(odd_documents(spark, []), model).count() == 0


def test_no_labels_of_a_kind(spark, learnt):
    documents = learnt[0]
    for rows in ([], [(1, 0), (2, 0)], [(1, 1)]):
        model = toxicity.fit(documents, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert not toxicity.score(documents, model).where("predicted = 1").count()

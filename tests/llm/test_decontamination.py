import random

import numpy as np

from plain import LOWER, corpus, odd_documents, spaced
from surveyloom.llm import decontamination as D

UPPER = {v: k for k, v in LOWER.items()}


def test_planted_items_are_found_and_clean_texts_left(spark):
    rnd = random.Random(2)
    items = [(i, " ".join(t.split()[: 15 + i])) for i, t in corpus(30, seed=9)] + [(90, None), (91, ""), (92, "two words"), (93, "not in any document at all here")]
    documents, planted = [], set()
    for i, text in corpus(120, seed=4):
        words = text.split()
        if i % 4 == 0:
            item, passage = items[i % 30]
            passage = passage.split()
            if i % 8 == 0 and len(passage) > 25:
                passage[0] = "other"
            at = rnd.randrange(len(words))
            words[at:at] = passage
            planted.add((i, item))
        documents.append((i, "  ".join(words).translate(UPPER)))
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = D.leaks(docs, frame).collect()
    assert planted <= {(r["doc_id"], r["item_id"]) for r in got}
    assert {r["doc_id"] for r in got} == {d for d, _ in planted}
    texts, bags = dict(documents), dict(items)
    for r in got:
        window = spaced(texts[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_words"]]
        assert r["similarity"] >= 0.8 and r["bits"] <= D.RADIUS
        assert abs(D.weighted_similarity(D.bag(window, 5), D.bag(spaced(bags[r["item_id"]]), 5)) - r["similarity"]) < 1e-12
    clean = D.without_leaks(docs, frame)
    assert {r["doc_id"] for r in clean.collect()} == set(range(120)) - {d for d, _ in planted}


def test_search_equals_all_windows():
    rnd = random.Random(0)
    items = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 14))).encode()) for i in range(40)]
    index = D.Items(items)
    for _ in range(60):
        words = [rnd.choice("abcdefgh").encode() for _ in range(40)]
        i, text = rnd.choice(items)
        words[5:5] = text.split()
        got = index.search(words)
        best = {}
        for k, (ident, text) in enumerate(items):
            item = text.split()
            length = min(5, len(item))
            for start in range(len(words) - len(item) + 1):
                window = words[start : start + len(item)]
                alike = D.weighted_similarity(D.bag(window, length), D.bag(item, length))
                h = D.shingle_hashes(D.word_hashes(window), length)
                bits = int(np.bitwise_count(D.window_fingerprints(h, np.zeros(1, np.int64), len(h))[0] ^ index.prints[k]))
                if alike >= 0.8 and bits <= D.RADIUS and (k not in best or alike > best[k][0]):
                    best[k] = (alike, bits, start, len(item))
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in best.items()}


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(0)
    index = D.Items([(i, f"a{i} b c d e{i} f".encode()) for i in range(300)])
    prints = index.prints[:50].copy()
    for i in range(50):
        for b in rng.choice(64, i % 20, replace=False):
            prints[i] ^= np.uint64(1 << int(b))
    window, item = index.near(prints)
    close = np.bitwise_count(prints[:, None] ^ index.prints[None, :]) <= D.RADIUS
    assert list(zip(window.tolist(), item.tolist())) == list(zip(*map(np.ndarray.tolist, np.nonzero(close))))


def test_blocks_of_items_and_odd_rows(spark, monkeypatch):
    items = spark.createDataFrame([(1, "same text here now"), (2, "x"), (3, None), (None, "a b c")], "item_id long, text string")
    whole = sorted(map(str, D.leaks(odd_documents(spark), items).collect()))
    kept = sorted(map(str, D.without_leaks(odd_documents(spark), items).collect()))
    assert len(whole) == 5
    monkeypatch.setattr(D, "ITEM_BYTES", 10)
    many, blocks = D.item_blocks(items, "item_id", "text", 10)
    blocks = list(blocks)
    assert many == len(blocks) > 1
    assert len(blocks) == 3 and sum(map(len, blocks)) == 3
    assert sorted(map(str, D.leaks(odd_documents(spark), items).collect())) == whole
    assert sorted(map(str, D.without_leaks(odd_documents(spark), items).collect())) == kept
    assert D.leaks(odd_documents(spark), items.limit(0)).count() == 0
    assert D.leaks(odd_documents(spark, []), items).count() == 0
    assert D.without_leaks(odd_documents(spark), items).columns == odd_documents(spark).columns

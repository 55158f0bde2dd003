import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from plain import ODD, corpus, odd_documents
from surveyloom.llm import packing
from surveyloom.llm.sharding import jump, shard

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_patterns_use_every_piece_once_and_fit():
    rnd = random.Random(0)
    for _ in range(30):
        histogram = {rnd.randint(1, 64): rnd.randint(1, 10**6) for _ in range(rnd.randint(0, 30))}
        used, patterns = {}, packing.shortest_pack_first(histogram, 64)
        for count, lengths in patterns:
            assert count > 0 and sum(lengths) <= 64 and lengths == sorted(lengths, reverse=True)
            for length in lengths:
                used[length] = used.get(length, 0) + count
        assert used == histogram
    # The pack with the most room left comes first.
    assert sorted(packing.shortest_pack_first({6: 2, 3: 1, 2: 2}, 8)) == [(1, [3, 2, 2]), (2, [6])]
    total = sum(c for c, _ in packing.shortest_pack_first({5: 10, 3: 10}, 8))
    assert total == 10


def test_ids_equal_the_library():
    rnd = random.Random(1)
    letters = "aAbTGΣσς's'RE'é́e \n\t\r\x0b\x1c\x85 　 ​٠17²Ⅷ.,!한가İßſ"
    library, own = Tokenizer.from_file(PATH), packing.Encoder(open(PATH).read())
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14)))
        if rnd.random() < 0.1:
            text += "<|endoftext|>" + text + " <|startoftext|>"
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def check(rows, got, size, end=2):
    library = Tokenizer.from_file(PATH)
    ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for _, t in rows]
    want = sorted(
        (str(i), at, min(size, len(x) - at), zlib.crc32(x[at : at + size].tobytes()), len(x))
        for (i, _), x in zip(rows, ids) for at in range(0, len(x), size)
    )
    assert sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), sum(r["length"] for r in got)


def test_every_id_lies_in_one_piece(spark):
    rows = corpus(300)
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), PATH, size=512).collect()
    sequences, ids = check(rows, got, 512)
    assert sequences <= 1.05 * ids / 512 + 1


def test_odd_rows(spark):
    got = packing.pack(odd_documents(spark), PATH).collect()
    check(ODD, got, 4096)
    assert packing.pack(odd_documents(spark, []), PATH).count() == 0


def test_jump_moves_only_into_the_new_shard():
    keys = np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64)
    before = jump(keys.copy(), 1)
    assert not before.any()
    for n in range(2, 45):
        after = jump(keys.copy(), n)
        moved = after != before
        assert (after[moved] == n - 1).all() and abs(moved.mean() - 1 / n) < 0.02
        before = after


def test_slots_are_gapless_and_odd_rows_kept(spark):
    rows = corpus(500) + ODD + [(77, "hot")] * 300
    got = shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 40).collect()
    slots, by_id = {}, {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        by_id.setdefault(r["doc_id"], set()).add((r["shard"], r["grown_shard"]))
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in by_id.values())
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    assert shard(odd_documents(spark), 40).count() == 11 and shard(odd_documents(spark, []), 40).count() == 0


def test_words_of_letters_are_remembered_once(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 6)
    plain, encoder = Tokenizer.from_file(PATH), packing.Encoder(open(PATH).read())
    texts = ["the quick brown fox", "it's 42 foxes, isn't it?", "the quick, the brown", "", "Straße naïve fox fox", "a b c d e f g h i", "the 1st it's"]
    encoder.encode(texts[:1])
    # Before, each of them was kept as a word and as a pre-token.
    assert set(encoder.words.young) == set(texts[0].split()) and not encoder.tokens.young
    for group in (texts, texts[::-1], texts[2:4]):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(group)]
        assert found == [plain.encode(t, add_special_tokens=False).ids for t in group]

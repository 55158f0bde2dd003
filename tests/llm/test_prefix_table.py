import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from plain import odd_documents, corpus, ODD
from surveyloom.llm import prefix_table
from surveyloom.llm.piece_model import NORMAL, PieceModel
from surveyloom.llm.prefix_table import Decoder, PrefixTable, merges

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def table():
    with open(MODEL, "rb") as file:
        return PrefixTable(PieceModel.read(file.read()))


@pytest.fixture(scope="module")
def decoder(table):
    return Decoder(table.model)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def some_text(rnd, pieces):
    kind = rnd.random()
    if kind < 0.4:
        return "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12)))
    if kind < 0.6:
        return "".join(rnd.choice("abeinst ▁.\n\r\t") for _ in range(rnd.randint(0, 40)))
    if kind < 0.8:
        ranges = [(1, 0x500), (0x4E00, 0x9FFF), (0x1F300, 0x1FAFF), (32, 32), (0x300, 0x36F)]
        return "".join(chr(rnd.randint(*rnd.choice(ranges))) for _ in range(rnd.randint(0, 30)))
    if kind < 0.9:
        return rnd.choice(["", " ", "\n"]).join(rnd.choice(["word", "Zahl", "é\n", "\n", "a\tb", "x.\nY", " ", "漢字"]) for _ in range(rnd.randint(0, 12)))
    return rnd.choice(["a", " ", "=", "-", "0", "\t", "\n", "<s>", "<0x41>", "</s>"]) * rnd.randint(0, 120)


def test_pieces_equal_the_library(library, table):
    assert table.model.texts == [library.id_to_piece(i) for i in range(library.get_piece_size())]
    assert table.model.of_kind(NORMAL) == [
        i for i in range(library.get_piece_size())
        if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
    ]


def test_ids_and_texts_equal_the_library(library, table, decoder):
    rnd = random.Random(1)
    pieces = [table.model.texts[i] for i in table.model.of_kind(NORMAL)]
    for _ in range(8000):
        text = some_text(rnd, pieces)
        want = library.encode(text)
        assert ids(table.encode(text)) == want, text
        assert decoder.decode(np.array(want, "<u4").tobytes()) == library.decode(want), text


def test_any_ids_decode_like_the_library(library, decoder):
    rnd = random.Random(2)
    for _ in range(4000):
        row = [rnd.choice([rnd.randint(0, 31_999), rnd.randint(0, 262)]) for _ in range(rnd.randint(0, 10))]
        assert decoder.decode(np.array(row, "<u4").tobytes()) == library.decode(row), row


def test_joined_tokens_are_those_that_merging_keeps_apart(table):
    rnd = random.Random(3)
    pieces = list(table.steps)
    checked = 0
    for _ in range(20_000):
        a, b = rnd.choice(pieces), rnd.choice(pieces)
        kept = merges(a + b, table.priority)[0] == [a, b]
        assert table.followers[a][b] == kept
        checked += not kept
    assert checked > 100


def test_forgotten_pairs_and_segments_change_nothing(monkeypatch, library, table):
    monkeypatch.setattr(prefix_table, "REMEMBERED", 3)
    monkeypatch.setattr(prefix_table, "REMEMBERED_PAIRS", 5)
    small = PrefixTable(table.model)
    for text in ("one two three one two four\nfive one " * 3, "a  b", "long" * 40 + " x"):
        assert ids(small.encode(text)) == library.encode(text)


def test_every_prefix_ends_with_the_last_token_of_its_own_encoding(library, table):
    segment = "▁unbelievably…internationalisation漢字ing"
    last = table.last_tokens(segment)
    for i in range(1, len(segment) + 1):
        assert last[i] == merges(segment[:i], table.priority)[0][-1]


def test_whole_table_with_odd_rows(spark, library):
    rows = corpus(60) + ODD + [(9, "x" * 200_000), (10, "word\r\n" * 30_000)]
    got = prefix_table.decode(prefix_table.encode(odd_documents(spark, rows), MODEL), MODEL).collect()
    found = sorted((str(r["doc_id"]), ids(r["ids"]), r["text"]) for r in got)
    once = prefix_table.encode(odd_documents(spark, rows), MODEL, decoded=True).collect()
    assert sorted((str(r["doc_id"]), ids(r["ids"]), r["text"]) for r in once) == found
    want = []
    for ident, text in rows:
        inner = library.encode(text or "")
        want.append((str(ident), [1, *inner, 2], library.decode(inner)))
    assert found == sorted(want)
    assert prefix_table.encode(odd_documents(spark, []), MODEL).count() == 0
    bare = prefix_table.encode(odd_documents(spark, [(1, ""), (2, None)]), MODEL, begin=False, end=False)
    assert [bytes(r["ids"]) for r in bare.collect()] == [b"", b""]
    missing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert prefix_table.decode(missing, MODEL).first()["text"] is None


def test_slices_are_bounded_and_whole(monkeypatch, spark, library):
    monkeypatch.setattr(prefix_table, "BATCH_BYTES", 500)
    import pyarrow as pa

    texts = ["a" * n for n in (0, 100, 600, 0, 300, 300, 1)]
    batch = pa.RecordBatch.from_pydict({"t": texts})
    parts = [p.column(0).to_pylist() for p in prefix_table.sliced(batch, [len(t) for t in texts])]
    assert sum(parts, []) == texts
    assert all(sum(map(len, p)) <= 500 or len([t for t in p if t]) == 1 for p in parts)


def test_models_that_are_not_supported_are_refused():
    with open(MODEL, "rb") as file:
        data = file.read()
    with pytest.raises(ValueError, match="user-defined"):
        # A field added to the end: one more piece, of kind 4.
        PieceModel.read(data + b"\x0a\x0a\x0a\x01x\x15\x00\x00\x00\x00\x18\x04")

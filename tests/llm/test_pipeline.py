import os

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from plain import CLASHES, components, near_pairs, simhash, spaced
from surveyloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_stages_keep_what_they_should(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    predicted = {r["doc_id"] for r in QUERIES["op2_toxicity"](spark, SF_DIR).where("predicted = 1").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def stored(name, frame):
        assert frame.columns == columns
        frame.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    docs = stored("1", stages["toxicity"](spark, docs, SF_DIR))
    assert {r["doc_id"] for r in docs.collect()} == set(texts) - predicted
    ids = sorted(r["doc_id"] for r in docs.collect())
    roots = components(len(ids), near_pairs([simhash(texts[i]) for i in ids], 2))
    docs = stored("2", stages["near_duplicates"](spark, docs, SF_DIR))
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted({ids[r] for r in roots})
    leaky = {r["doc_id"] for r in QUERIES["op1_benchmark_decontamination"](spark, SF_DIR).collect()}
    docs = stored("3", stages["decontamination"](spark, docs, SF_DIR))
    kept = sorted(r["doc_id"] for r in docs.collect())
    assert kept == sorted({ids[r] for r in roots} - leaky)
    items = [b" ".join(spaced(r["text"])) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert not any(i in b" ".join(spaced(texts[d])) for d in kept for i in items)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: len(library.encode(texts[d], add_special_tokens=False).ids) + 1 for d in kept}
    rows = stages["packing"](spark, docs, SF_DIR).collect()
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    for got in (rows, whole):
        held = {}
        for r in got:
            held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
        assert held == want


def test_one_row_of_each_group_stays_with_odd_rows(spark, tmp_path):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, "only here now"), (None, "only here now"), (5, None), (4, "")]
    schema = "doc_id long, text string, _place string, " + ", ".join(f"{c} string" for c in CLASHES)
    spark.createDataFrame([(*r, "p", *CLASHES) for r in rows], schema).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == [("1", "a b c d"), ("4", ""), ("None", "only here now")]
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), SF_DIR).count() == 0

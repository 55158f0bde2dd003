"""Token counts: pieces counted once per distinct pre-token, joined to per-document frequencies."""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.chunks import (
    bucket_of,
    buckets_for,
    by_bucket,
    chunked,
    pack_ints,
    pack_rising,
    unpack_ints,
    unpack_rising,
)
from surveyloom.session import ship_package, store

# Fixed value: the pre-tokens of the byte-level BPE. White space is as the tokenizer has it.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


@cache
def tokenizer_of(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def pre_tokens(text: str, special: list[str]) -> tuple[Counter, int]:
    """How often each pre-token stands in a text, and how many special strings, each a token that splits the text."""
    parts = [text]
    for one in special:
        if one in text:
            parts = [p for part in parts for p in part.split(one)]
    counted = Counter()
    for part in parts:
        counted.update(PRE_TOKEN.findall(part))
    return counted, len(parts) - 1


def count_tokens(df: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, n_bytes, n_tokens) for every row of ``df``, tokens as the library's default gives them without added ones.

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers``
    library. Chunks of documents keep pre-token frequencies by their own
    numbers; each distinct pre-token is encoded in one place and only its number
    of pieces comes back.

    Null and empty texts have no tokens; null ids and repeated rows come back
    as they are; an empty table gives no rows. Other columns are not looked at.
    """
    spark = df.sparkSession
    ship_package(spark)
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text())  # the file has a fixed size
    narrow = df.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    kind = df.schema[ident].dataType.simpleString()
    buckets = buckets_for(narrow)
    schema = (
        f"chunk long, ident {kind}, n_bytes long, special long, places binary, times binary, "
        "bucket int, words array<string>, numbers binary"
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = [t.content for t in tokenizer_of(definition.value).get_added_tokens_decoder().values()]

        def emit(chunk: int, rows: pa.Table, texts: list[str]) -> Iterator[pa.RecordBatch]:
            number: dict[str, int] = {}
            n_bytes, specials, places, times = [], [], [], []
            for t in texts:
                counted, found = pre_tokens(t, special)
                at = np.fromiter((number.setdefault(w, len(number)) for w in counted), np.int64, len(counted))
                order = np.argsort(at)
                n_bytes.append(len(t.encode()))
                specials.append(found)
                places.append(pack_rising(at[order]))
                times.append(pack_ints(np.fromiter(counted.values(), np.int64, len(counted))[order]))
            n = len(texts)
            ids = rows.column(0).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, chunk)), ids, pa.array(n_bytes, pa.int64()), pa.array(specials, pa.int64()),
                    pa.array(places, pa.binary()), pa.array(times, pa.binary()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.binary()),
                ],
                names,
            )
            words = list(number)
            dealt = list(by_bucket(np.fromiter((bucket_of(w.encode(), buckets) for w in words), np.int64, len(words)))) if words else []
            n = len(dealt)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, chunk)), pa.nulls(n, ids.type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                    pa.array([b for b, _ in dealt], pa.int32()),
                    pa.array([[words[i] for i in at] for _, at in dealt], pa.list_(pa.string())),
                    pa.array([pack_rising(at) for _, at in dealt], pa.binary()),
                ],
                names,
            )

        names = ["chunk", "ident", "n_bytes", "special", "places", "times", "bucket", "words", "numbers"]
        return chunked(batches, lambda b: [t or "" for t in b.column(1).to_pylist()], emit)

    stored = store(narrow.mapInArrow(frequencies, schema), "frequencies")

    def count_pieces(table: pa.Table) -> pa.Table:
        """One bucket: encode each distinct pre-token once, reply to every chunk that has it."""
        lists = table.column("words").combine_chunks()
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        pieces = np.zeros(len(words), np.int64)
        encode = tokenizer_of(definition.value).encode_batch_fast
        for i in range(0, len(words), 10_000):
            pieces[i : i + 10_000] = [len(e.ids) for e in encode(words[i : i + 10_000], add_special_tokens=False)]
        replies = np.split(pieces[coded.indices.to_numpy()], lists.offsets.to_numpy()[1:-1])
        return pa.table({
            "chunk": table.column("chunk"),
            "numbers": table.column("numbers"),
            "pieces": pa.array([pack_ints(r) for r in replies], pa.binary()),
        })

    replies = (
        stored.where("bucket is not null").select("chunk", "bucket", "words", "numbers")
        .groupBy("bucket").applyInArrow(count_pieces, "chunk long, numbers binary, pieces binary")
    )

    def add_up(documents: pa.Table, replies: pa.Table) -> pa.Table:
        """One chunk: pieces by number, then each document's sum of times by pieces."""
        numbers = [unpack_rising(n) for n in replies.column("numbers").to_pylist()]
        pieces = np.zeros(1 + max((int(n[-1]) for n in numbers), default=0), np.int64)
        for n, p in zip(numbers, replies.column("pieces").to_pylist()):
            pieces[n] = unpack_ints(p)
        rows = zip(*(documents.column(c).to_pylist() for c in ("places", "times", "special")))
        tokens = [int(pieces[unpack_rising(p)] @ unpack_ints(t)) + s for p, t, s in rows]
        return pa.table({
            "ident": documents.column("ident"), "n_bytes": documents.column("n_bytes"), "n_tokens": pa.array(tokens, pa.int64())
        })

    documents = stored.where("bucket is null").select("chunk", "ident", "n_bytes", "special", "places", "times")
    counted = documents.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        add_up, f"ident {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumnRenamed("ident", ident)

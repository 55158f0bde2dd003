"""Language-model scores from a bigram trie with absolute discounting, spread over buckets of contexts."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.chunks import (
    bucket_of,
    buckets_for,
    by_bucket,
    chunked,
    pack_ints,
    pack_rising,
    pack_runs,
    unpack_ints,
    unpack_rising,
    unpack_runs,
)
from surveyloom.llm.common import spaced_words, utf8
from surveyloom.llm.trie import Trie
from surveyloom.session import ship_package, store

# The token after a text's last word; words hold no white space.
END = b"\n"
# What is taken off the count of every pair, and given to the distribution below: Kneser and Ney's customary discount.
DISCOUNT = 0.75
# Stands for every token that training does not have; numbers of tokens are smaller.
NONE = 0xFFFFFFFF
# Probabilities are kept in steps of so many decades, rounded down, from 1 to 0 on; code 0 is none.
STEP = 0.001
# A context with more than this share of a bucket's tokens is spread over several buckets.
HOT = 0.5


def code_of(probability: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.ceil(-np.log10(probability) / STEP - 1e-9), 65535).astype(np.uint16)


def value_of(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) * STEP), 0.0)


def empty(kinds: dict[str, pa.DataType], **columns) -> pa.RecordBatch:
    """Rows with these columns, the others null."""
    n = len(next(iter(columns.values())))
    arrays = []
    for name, kind in kinds.items():
        column = columns.get(name)
        arrays.append(pa.nulls(n, kind) if column is None else column if isinstance(column, pa.Array) else pa.array(column, kind))
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


class Vocabulary:
    """What a chunk knows of its tokens: global numbers and training counts, by its own numbers."""

    def __init__(self, size: int, replies: list[tuple[bytes, bytes, bytes]]):
        self.ids, self.counts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for numbers, ids, counts in replies:
            at = unpack_rising(numbers)
            self.ids[at], self.counts[at] = unpack_ints(ids), unpack_ints(counts)


def spread_of(of_context: np.ndarray, buckets: int, total: int) -> np.ndarray:
    """Over how many buckets contexts with these counts are spread, by token."""
    return 1 + (of_context * buckets / (HOT * max(total, 1))).astype(np.int64)


class Pairs:
    """The distinct (context, token) pairs of a chunk whose context training has, dealt to buckets of contexts.

    ``which`` gives the pair of each token of the chunk, -1 for none; a text's
    first token has the end as its context. Tokens that training does not have
    are one token, ``NONE``.
    """

    def __init__(self, tokens: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary, total: int, buckets: int):
        end = int(ends[0])
        context = np.concatenate([[end], tokens[:-1]])
        known = vocabulary.counts[context] > 0
        named = np.where(vocabulary.counts > 0, vocabulary.ids, NONE)
        both = vocabulary.ids[context[known]] << 32 | named[tokens[known]]
        pairs, first, inverse = np.unique(both, return_index=True, return_inverse=True)
        self.which = np.full(len(tokens), -1, np.int64)
        self.which[known] = inverse
        self.contexts, self.tokens = pairs >> 32, pairs & 0xFFFFFFFF
        self.of_context = vocabulary.counts[context[known][first]]
        self.spread = spread_of(self.of_context, buckets, total)
        mixed = self.contexts * 0x9E3779B1 + self.tokens % self.spread * 0x85EBCA77
        self.bucket = ((mixed ^ mixed >> 29) & 0x7FFFFFFF) % buckets

    def __len__(self) -> int:
        return len(self.contexts)


def score(
    df: DataFrame, trains: Column, ident: str = "doc_id", text: str = "text", discount: float = DISCOUNT, levels: bool = False
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """(ident, trains, n_tokens, n_known, train_tokens, base_score, score) for every row of ``df``.

    Learns from the rows for which ``trains`` holds. ``base_score`` is the log10
    probability under smoothed token counts, ``score`` that under

        P(w | v) = max(count(v, w) - discount, 0) / count(v) + discount * kinds(v) / count(v) * P(w)

    with P(w) as in the base score, v the token before and the end before the
    first, and kinds(v) how many different tokens follow v (interpolated
    absolute discounting); in an unknown context P(w | v) = P(w). The first part
    is what the trie holds, as codes rounded down, so that no context gives out
    more than 1.

    Chunks of documents look their tokens up once each, then their distinct
    pairs; a bucket of contexts counts its pairs over all chunks, builds its
    trie and answers from it. A context with so many tokens that they are spread
    over several buckets has its kinds added up from all of them: fewer than four
    numbers a bucket. With ``levels`` the tries come too: (bucket, trie).

    Null and empty texts are the end alone; null ids and repeated rows come
    back as they are; where ``trains`` is null a row does not train; without
    training rows every token is unknown and both scores are 0 for the one
    class there is; an empty table gives no rows. Other columns are not looked at.
    """
    spark = df.sparkSession
    ship_package(spark)
    narrow = df.select(
        F.col(ident).alias("ident"), F.coalesce(trains, F.lit(False)).alias("trains"), F.col(text).alias("text")
    )
    ident_type = df.schema[ident].dataType.simpleString()
    buckets = buckets_for(narrow)
    columns = (
        f"chunk long, ident {ident_type}, trains boolean, tokens binary, size long, "
        "bucket int, words array<binary>, numbers binary, counts binary"
    )

    # 1. Documents as numbers of the chunk, and the chunk's words for each bucket.
    def number_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(chunk: int, rows: pa.Table, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            trained = rows.column("trains").to_pylist()
            number[END]
            listed, lengths = [], []
            for t in texts:
                words = spaced_words(t)
                words.append(END)
                lengths.append(len(words))
                listed += map(number.__getitem__, words)
            tokens, lengths = np.array(listed, np.int64), np.array(lengths)
            counts = np.bincount(tokens[np.repeat(np.array(trained, bool), lengths)], minlength=len(number))
            n = len(texts)
            yield empty(
                kinds, chunk=np.full(n, chunk), ident=rows.column("ident").combine_chunks(), trains=trained,
                tokens=pack_runs(tokens, lengths), size=np.full(n, len(number)),
            )
            words = list(number)
            dealt = list(by_bucket(np.fromiter((bucket_of(w, buckets) for w in words), np.int64, len(words))))
            yield empty(
                kinds, chunk=np.full(len(dealt), chunk), bucket=[b for b, _ in dealt],
                words=[[words[i] for i in at] for _, at in dealt],
                numbers=[pack_rising(at) for _, at in dealt], counts=[pack_ints(counts[at]) for _, at in dealt],
            )

        kinds = {
            "chunk": pa.int64(), "ident": None, "trains": pa.bool_(), "tokens": pa.binary(), "size": pa.int64(),
            "bucket": pa.int32(), "words": pa.list_(pa.binary()), "numbers": pa.binary(), "counts": pa.binary(),
        }
        for first in batches:
            kinds["ident"] = first.schema.field("ident").type

            def all_batches(first=first):
                yield first
                yield from batches

            yield from chunked(all_batches(), lambda b: utf8(b.column(2)), emit)

    stored = store(narrow.mapInArrow(number_words, columns), "numbered")
    documents = stored.where("bucket is null").select("chunk", "ident", "trains", "tokens", "size")

    # 2. Each bucket counts its words over all chunks and replies with global numbers, frequent ones small.
    def count_words(table: pa.Table) -> pa.Table:
        lists = table.column("words").combine_chunks()
        coded = lists.flatten().dictionary_encode()
        at, bounds = coded.indices.to_numpy(), lists.offsets.to_numpy()
        sums = np.zeros(len(coded.dictionary), np.int64)
        for part, counts in zip(np.split(at, bounds[1:-1]), table.column("counts").to_pylist()):
            sums[part] += unpack_ints(counts)
        rank = np.empty(len(sums), np.int64)
        rank[np.argsort(-sums, kind="stable")] = np.arange(len(sums))
        ids = rank * buckets + int(table.column("bucket")[0].as_py())
        parts = np.split(at, bounds[1:-1])
        chunk, numbers = table.column("chunk").to_pylist(), table.column("numbers").to_pylist()
        return pa.table({
            "chunk": pa.array([*chunk, None], pa.int64()), "numbers": pa.array([*numbers, None], pa.binary()),
            "ids": pa.array([*(pack_ints(ids[p]) for p in parts), None], pa.binary()),
            "counts": pa.array([*(pack_ints(sums[p]) for p in parts), None], pa.binary()),
            "total": pa.array([None] * len(chunk) + [int(sums.sum())], pa.int64()),
            "distinct": pa.array([None] * len(chunk) + [int((sums > 0).sum())], pa.int64()),
        })

    vocabulary = store(
        stored.where("bucket is not null").select("chunk", "bucket", "words", "numbers", "counts")
        .repartition(buckets, "bucket").groupBy("bucket")
        .applyInArrow(count_words, "chunk long, numbers binary, ids binary, counts binary, total long, distinct long"),
        "vocabulary",
    )
    sums = vocabulary.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"] or 0)
    words = vocabulary.where("chunk is not null").select("chunk", "numbers", "ids", "counts")

    def open_chunk(documents: pa.Table, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, Vocabulary, Pairs]:
        """(how many tokens each text has, all tokens, what is known of them, their pairs)."""
        tokens, lengths = unpack_runs(documents.column("tokens").to_pylist())
        rows = zip(*(replies.column(c).to_pylist() for c in ("numbers", "ids", "counts")))
        known = Vocabulary(int(documents.column("size")[0].as_py()), list(rows))
        return lengths, tokens, known, Pairs(tokens, tokens[np.cumsum(lengths) - 1], known, total, buckets)

    # 3. Each chunk sends its distinct pairs, with how often training has them.
    def send_pairs(documents: pa.Table, replies: pa.Table) -> pa.Table:
        if not documents.num_rows:
            return pa.table({n: pa.array([], t) for n, t in pair_kinds.items()})
        lengths, tokens, known, pairs = open_chunk(documents, replies)
        trained = np.repeat(np.array(documents.column("trains").to_pylist(), bool), lengths)
        counts = np.bincount(pairs.which[trained & (pairs.which >= 0)], minlength=len(pairs))
        rows = []
        for bucket, at in by_bucket(pairs.bucket):
            context, first = np.unique(pairs.contexts[at], return_index=True)
            runs = np.diff(np.append(first, len(at)))
            rows.append((bucket, *map(pack_ints, (np.diff(context, prepend=0), runs, pairs.of_context[at[first]], pairs.tokens[at], counts[at]))))
        columns = list(zip(*rows)) or [[]] * 6
        chunk = documents.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array([chunk] * len(rows), pa.int64())} | {
            n: pa.array(c, t) for (n, t), c in zip(list(pair_kinds.items())[1:], columns)
        })

    pair_kinds = {
        "chunk": pa.int64(), "bucket": pa.int32(), "contexts": pa.binary(), "runs": pa.binary(), "of_context": pa.binary(),
        "tokens": pa.binary(), "counts": pa.binary(),
    }
    # As many tasks as buckets, so that what a task reads does not grow with the input.
    both = [t.repartition(buckets, "chunk").groupBy("chunk") for t in (documents, words)]
    sent = both[0].cogroup(both[1]).applyInArrow(
        send_pairs, "chunk long, bucket int, contexts binary, runs binary, of_context binary, tokens binary, counts binary"
    )

    # 4. Each bucket counts its pairs over all chunks, builds its trie and looks every chunk's pairs up in it.
    def answer(table: pa.Table) -> pa.Table:
        messages = []
        for row in zip(*(table.column(c).to_pylist() for c in ("contexts", "runs", "of_context", "tokens", "counts"))):
            gaps, runs, of_context, tokens, counts = map(unpack_ints, row)
            messages.append((np.repeat(np.cumsum(gaps), runs), tokens, counts, np.repeat(of_context, runs)))
        contexts, tokens, counts, of_context = map(np.concatenate, zip(*messages))
        # All chunks' pairs once each; those that training has go into the trie, which then answers for all.
        pairs, first, which = np.unique(contexts << 32 | tokens, return_index=True, return_inverse=True)
        sums = np.bincount(which, weights=counts, minlength=len(pairs)).astype(np.int64)
        rows = np.flatnonzero(sums)
        contexts, tokens, of_context = pairs >> 32, pairs & 0xFFFFFFFF, of_context[first]
        trie = Trie.view(
            Trie.build(contexts[rows], tokens[rows], code_of((sums[rows] - discount) / of_context[rows])).to_bytes()
        )
        found = trie.find(contexts, tokens)[which]
        replies = pack_runs(found, np.array([len(m[0]) for m in messages]))
        # How many kinds of tokens follow each context, in the order of a message's contexts.
        some, begins = np.unique(contexts, return_index=True)
        kinds = np.add.reduceat((sums > 0).astype(np.int64), begins)
        asked = [m[0][np.flatnonzero(np.diff(m[0], prepend=-1))] for m in messages]
        each = pack_runs(kinds[np.searchsorted(some, np.concatenate(asked))], np.array(list(map(len, asked))))
        hot = np.flatnonzero(spread_of(of_context[begins], buckets, total) > 1)
        bucket = int(table.column("bucket")[0].as_py())
        chunk = table.column("chunk").to_pylist()
        # Behind the chunks' replies: the kinds of the bucket's spread contexts, and the trie if it is wanted.
        return pa.table({
            "chunk": pa.array([*chunk, None], pa.int64()), "bucket": pa.array([bucket] * (len(chunk) + 1), pa.int32()),
            "codes": pa.array([*replies, None], pa.binary()), "kinds": pa.array([*each, pack_ints(kinds[hot])], pa.binary()),
            "hot": pa.array([None] * len(chunk) + [pack_rising(some[hot])], pa.binary()),
            "trie": pa.array([None] * len(chunk) + [trie.to_bytes() if levels else None], pa.binary()),
        })

    answers = store(
        sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, codes binary, kinds binary, hot binary, trie binary"), "answers"
    )
    # Of each spread context one number for each of its buckets.
    spread: dict[int, int] = {}
    for r in answers.where("chunk is null").select("hot", "kinds").collect():
        for context, n in zip(unpack_rising(r["hot"]).tolist(), unpack_ints(r["kinds"]).tolist()):
            spread[context] = spread.get(context, 0) + n
    listed = sorted(spread)
    shared = spark.sparkContext.broadcast((np.array(listed, np.int64), np.array([spread[c] for c in listed], np.int64)))

    # 5. Each chunk adds up the logarithms of its documents' tokens.
    parts = (
        documents.withColumn("part", F.lit(0))
        .unionByName(words.withColumn("part", F.lit(1)), allowMissingColumns=True)
        .unionByName(answers.where("chunk is not null").select("chunk", "bucket", "codes", "kinds").withColumn("part", F.lit(2)), allowMissingColumns=True)
    )

    def add_up(table: pa.Table) -> pa.Table:
        part = table.column("part").to_numpy()
        documents, replies, answered = (table.filter(pa.array(part == i)) for i in range(3))
        lengths, tokens, known, pairs = open_chunk(documents, replies)
        codes, kinds = np.zeros(len(pairs) + 1, np.uint16), np.zeros(len(pairs) + 1, np.int64)
        rows = zip(*(answered.column(c).to_pylist() for c in ("bucket", "codes", "kinds")))
        found = {bucket: replies for bucket, *replies in rows}
        for bucket, at in by_bucket(pairs.bucket):
            codes[at] = unpack_ints(found[bucket][0])
            begins = np.diff(pairs.contexts[at], prepend=-1) != 0
            kinds[at] = unpack_ints(found[bucket][1])[np.cumsum(begins) - 1]
        hot = np.flatnonzero(pairs.spread > 1)
        kinds[hot] = shared.value[1][np.searchsorted(shared.value[0], pairs.contexts[hot])]
        count = known.counts[tokens]
        single = (count + 0.5) / (total + 0.5 * (distinct + 1))
        first = np.cumsum(lengths) - lengths
        context = known.counts[np.concatenate([[tokens[-1]], tokens[:-1]])]
        both = value_of(codes[pairs.which]) + discount * kinds[pairs.which] / np.maximum(context, 1) * single
        return pa.table({
            "ident": documents.column("ident"), "trains": documents.column("trains"),
            "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
            "base_score": pa.array(np.add.reduceat(np.log10(single), first)),
            "score": pa.array(np.add.reduceat(np.log10(np.where(context > 0, both, single)), first)),
        })

    scored = parts.repartition(buckets, "chunk").groupBy("chunk").applyInArrow(
        add_up, f"ident {ident_type}, trains boolean, n_tokens long, n_known long, base_score double, score double"
    )
    out = scored.select(
        F.col("ident").alias(ident), "trains", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
    return (out, answers.where("trie is not null").select("bucket", "trie")) if levels else out

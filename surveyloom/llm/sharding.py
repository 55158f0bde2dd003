"""Sharding by jump consistent hashing of stable keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import map_batches, rank_within
from surveyloom.session import store

# Bytes a row takes beside its text.
ROW_BYTES = 16
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key. With one more shard a key stays or moves to the new one."""
    keys = keys.astype(np.uint64)
    bucket = np.full(len(keys), -1, np.int64)
    ahead = np.zeros(len(keys), np.int64)
    going = np.arange(len(keys))
    while len(going):
        bucket[going] = ahead[going]
        keys[going] = keys[going] * STEP + np.uint64(1)
        chance = ((keys[going] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[going] = ((bucket[going] + 1) * ((1 << 31) / chance)).astype(np.int64)
        going = going[ahead[going] < shards]
    return bucket


def shard(df: DataFrame, shards: int, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, size, text_crc32, law, shard, slot, grown_shard) for every row of ``df``.

    The law is ``key``: the id and the number of shards decide, so rows of one
    id share a shard. ``grown_shard`` is the shard if there were one more; it
    differs only where that one is it. ``slot`` numbers a shard's rows from 0.

    Null texts have no bytes and the crc32 of an empty text; null ids share a
    shard; repeated rows get slots of their own; an empty table gives no rows.
    Other columns are not looked at. Only these narrow columns are shuffled,
    and no task numbers a whole shard.
    """
    utf8 = F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))
    narrow = df.select(
        F.col(ident).alias("ident"),
        (F.octet_length(utf8) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        F.xxhash64(ident).alias("key"),
    )

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(3).to_numpy().view(np.uint64)
        found = [pa.array(jump(keys, n).astype(np.int32)) for n in (shards, shards + 1)]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], *found], ["ident", "size", "text_crc32", "shard", "grown_shard"])

    kind = df.schema[ident].dataType.simpleString()
    placed = map_batches(narrow, place, f"ident {kind}, size long, text_crc32 long, shard int, grown_shard int")
    stored = store(placed.withColumn("place", F.monotonically_increasing_id()), "shards")
    return rank_within(stored, ["shard"], "place", "slot").select(
        F.col("ident").alias(ident), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard",
    )

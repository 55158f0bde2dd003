"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.session import ship_package

# Letters A-Z become a-z; what is neither a digit, a letter nor beyond ASCII becomes a space.
PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after lower-casing A-Z."""
    return text.translate(PLAIN).split()


def spaced_words(text: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text after lower-casing A-Z."""
    return text.lower().split()


def utf8(array: pa.Array) -> list[bytes]:
    """A string column as bytes; null is empty."""
    return [x or b"" for x in pc.cast(array, pa.binary()).to_pylist()]


def fold(ident: str, folds: int) -> Column:
    """crc32 of an id written as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``function`` to each Arrow batch. Rows stay in their tasks, so nothing is shuffled."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    ship_package(df.sparkSession)
    return df.mapInArrow(over, schema)


class Memo(dict):
    """A bounded cache of ``make(key)`` in two generations.

    When the young one is full it becomes the old one, whose entries come back
    when they are asked for; what nobody asked for is forgotten. That costs time
    but changes no result.
    """

    def __init__(self, make: Callable, most: int = 200_000):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old[key] if key in self.old else self.make(key)
        self[key] = value
        return value


# ``monotonically_increasing_id`` keeps the partition above this many bits.
PART_BITS = 33


def rank_within(stored: DataFrame, group: list[str], place: str, name: str) -> DataFrame:
    """Number the rows of each group from 0, gapless, in the order of ``place``.

    ``stored`` has to be a stored table with ``place`` from
    ``monotonically_increasing_id`` in it. A row's number is its place among the
    group's rows of its part plus those of earlier parts, so a group of any
    size is numbered by many tasks.
    """
    part = F.shiftright(place, PART_BITS).alias("_part")
    sizes = stored.groupBy(*group, part).agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*group, "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_part").orderBy(place)
    return (
        stored.withColumn("_part", part)
        .join(before, [*group, "_part"])
        .withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_part", "_before")
    )

"""Consecutive row numbers without a single task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.session import checkpoint

# ``monotonically_increasing_id`` keeps the partition above this many bits.
ROW_BITS = 33


def number_rows(frame: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number rows 1..n in a total order.

    The sort is by range, so partitions hold consecutive stretches; a row's
    number is its place in the partition plus the rows in earlier partitions.
    The sorted rows are checkpointed, since both are read from them and have to
    agree even when an executor is lost in between.
    """
    ranked = checkpoint(frame.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", ROW_BITS)
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per partition, not per row.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        ranked.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_before") + inside + 1)
        .drop("_part", "_place", "_before")
    )

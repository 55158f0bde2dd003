"""Frames of different columns as one, and keys and labels as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_by_name(frames: Sequence[DataFrame] | Mapping[str, DataFrame], source: str | None = None) -> DataFrame:
    """All rows of all frames, a column that a frame lacks being null in its rows.

    Columns come in the order in which they first occur. A column of one name
    and several types becomes the widest of them if they are numbers, else text
    (nested values as JSON). With a mapping, ``source`` names a column for its
    keys.
    """
    named = list(frames.items()) if isinstance(frames, Mapping) else [(None, f) for f in frames]
    kinds: dict[str, list[T.DataType]] = {}
    for _, frame in named:
        for f in frame.schema.fields:
            if f.dataType not in kinds.setdefault(f.name, []):
                kinds[f.name].append(f.dataType)
    common = {name: _common(found) for name, found in kinds.items()}

    def aligned(label: str | None, frame: DataFrame) -> DataFrame:
        columns = []
        for name, kind in common.items():
            if name not in frame.columns:
                columns.append(F.lit(None).cast(kind).alias(name))
                continue
            nested = isinstance(frame.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
            as_text = isinstance(kind, T.StringType) and nested
            columns.append((F.to_json(name) if as_text else F.col(f"`{name}`").cast(kind)).alias(name))
        return frame.select(*([F.lit(label).alias(source)] if source else []), *columns)

    return reduce(DataFrame.unionByName, (aligned(*n) for n in named))


def _common(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type that holds values of all of them."""
    known = [k for k in kinds if not isinstance(k, T.NullType)]
    if len(known) < 2:
        return (known or [T.StringType()])[0]
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if all(type(k) in whole for k in known):
        return max(known, key=lambda k: whole.index(type(k)))
    if all(isinstance(k, T.NumericType) for k in known):
        return T.DoubleType()
    return T.StringType()


def to_text(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` as text, so that keys and labels of any type compare with each other.

    Whole numbers lose a fraction of zero: the id 3.0 is ``3``. What is missing stays missing.
    """
    def text(name: str):
        kind = frame.schema[name].dataType
        value = F.col(name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            whole = (value == F.rint(value)) & (F.abs(value) < 1e15)
            return F.when(whole, value.cast("long").cast("string")).otherwise(value.cast("string"))
        if isinstance(kind, T.DecimalType) and kind.scale:
            return F.regexp_replace(value.cast("string"), r"\.0+$", "")
        return value.cast("string")

    return frame.withColumns({name: text(name) for name in columns})

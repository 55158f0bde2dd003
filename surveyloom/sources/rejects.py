"""JSON documents that are broken, told apart from those that can be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.json import STRICT

BROKEN = "_broken"


def parsed_documents(documents: DataFrame, column: str, shape: str, mode: str = STRICT) -> DataFrame:
    """``documents`` with ``column`` read as the struct type ``shape``.

    A broken document, or one that is no JSON object, ends the job; with
    ``mode="PERMISSIVE"`` it is passed over. :func:`rejected_documents` has those.
    """
    if mode == STRICT:
        return documents.withColumn(column, F.from_json(column, shape, {"mode": mode}))
    return _read(documents, column, shape).where(f"{column} is not null and {column}.{BROKEN} is null").withColumn(column, F.col(column).dropFields(BROKEN))


def rejected_documents(documents: DataFrame, column: str, shape: str) -> DataFrame:
    """The documents that cannot be read as ``shape``: other columns, ``problem`` and the text as ``record``."""
    others = [c for c in documents.columns if c != column]
    text = documents.withColumn("record", F.col(column))
    broken = _read(text, column, shape).where(f"{column}.{BROKEN} is not null or {column} is null")
    return broken.select(*others, F.when(F.col("record").isNull(), "missing").otherwise("malformed").alias("problem"), "record")


def _read(documents: DataFrame, column: str, shape: str) -> DataFrame:
    """Documents read so that the text of a broken one is kept in the field ``BROKEN``."""
    widened = f"{shape[:-1]},{BROKEN}:string>"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    text = F.col(column)
    whole = F.when(text.rlike(r"^\s*\{"), F.from_json(text, widened, options))
    # What begins like anything but an object is broken as a whole.
    none = F.from_json(F.lit("{}"), widened).withField(BROKEN, text)
    return documents.withColumn(column, F.when(text.isNotNull(), F.coalesce(whole, none)))


def account_of(landed: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: documents ``landed``, of them ``parsed`` and ``rejected``."""
    counts = landed.agg(F.count("*").alias("landed")).crossJoin(rejected.agg(F.count("*").alias("rejected")))
    return counts.select("landed", (F.col("landed") - F.col("rejected")).alias("parsed"), "rejected")

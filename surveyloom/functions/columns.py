"""Structure carried by answer column names.

A name is ``[loop sep] QIDn [sep part]...`` with ``_`` or ``#`` as separator:
``QID4_1``, ``QID3_TEXT``, ``2_QID1``, ``QID9_1_GROUP``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how an answer column is named.
COLUMN_ID = r"^(?:([^_#]+)[_#])?QID(\d+)(?:[_#]([^_#]*))?((?:[_#][^_#]*)*)$"


def is_question_column(column_id: Column) -> Column:
    # Most metadata names fail the first, cheap test.
    return column_id.contains("QID") & column_id.rlike(COLUMN_ID)


def _part(column_id: Column, group: int) -> Column:
    return F.regexp_extract(column_id, COLUMN_ID, group)


def _int(text: Column) -> Column:
    return F.coalesce(F.when(text.rlike(r"^\d+$"), text).try_cast("bigint"), F.lit(0).cast("bigint"))


def base_qid(column_id: Column) -> Column:
    """``2_QID4_1`` -> ``QID4``; null for names that carry no question."""
    return F.when(is_question_column(column_id), F.concat(F.lit("QID"), _part(column_id, 2)))


def loop_no(column_id: Column) -> Column:
    return _int(_part(column_id, 1))


def question_no(column_id: Column) -> Column:
    return _int(_part(column_id, 2))


def sub_key(column_id: Column) -> Column:
    """First part after the question, as it is written (``''`` if none)."""
    return _part(column_id, 3)


def sub_no(column_id: Column) -> Column:
    return _int(sub_key(column_id))


def suffix(column_id: Column) -> Column:
    """Last part after the question when it is a word (``TEXT``, ``GROUP``), else ``''``."""
    last = F.regexp_extract(column_id, r"[_#]([^_#]*)$", 1)
    return F.when(
        is_question_column(column_id) & ~last.rlike(r"^(\d*|QID\d+)$"), last
    ).otherwise(F.lit(""))


def parse_column_id(column_id: Column) -> Column:
    """All parts in one struct."""
    return F.struct(
        base_qid(column_id).alias("base_qid"),
        loop_no(column_id).alias("loop_no"),
        question_no(column_id).alias("question_no"),
        sub_key(column_id).alias("sub_key"),
        sub_no(column_id).alias("sub_no"),
        suffix(column_id).alias("suffix"),
    )

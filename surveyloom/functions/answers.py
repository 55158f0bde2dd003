"""Expressions over one answer: ``struct(column_id, kind, items, num, txt)``.

``kind`` is one of ``list``, ``text``, ``number``, ``bool``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANSWER_TYPE = "struct<column_id:string,kind:string,items:array<string>,num:double,txt:string>"

NULL_CODE = "NULL"

# Fixed value: characters that count as digits - decimal digits of every
# script, superscript and subscript ones, and circled, bracketed, dotted and dingbat ones.
DIGITS = (
    r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉\x{1369}-\x{1371}\x{19DA}①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}]+$"
)


def is_digits(text: Column) -> Column:
    return text.rlike(DIGITS)


def has_answer(answer: Column) -> Column:
    """False for nothing at all, an empty text and an empty list."""
    return F.coalesce(
        F.when(answer["kind"] == "list", F.size(answer["items"]) > 0)
        .when(answer["kind"] == "text", answer["txt"] != "")
        .otherwise(answer["kind"].isNotNull()),
        F.lit(False),
    )


def answer_to(answers: Column, column_id: str) -> Column:
    """The answer to one column of a response's ``answers`` array, or null."""
    return F.get(F.filter(answers, lambda a: a["column_id"] == column_id), F.lit(0))


def answer_text(answer: Column) -> Column:
    """Free-text form of an answer."""
    return F.coalesce(answer["txt"], answer["num"].cast("string"))


def whole_number_text(number: Column) -> Column:
    """``3.7`` -> ``'3'``: cut toward zero, then written as text.

    A number of more than 38 digits, or none at all, counts as given without a code.
    """
    beyond = number.try_cast("decimal(38,0)")  # whole already
    return F.coalesce(number.try_cast("bigint").cast("string"), beyond.cast("string"), F.lit(NULL_CODE))


def codes(answer: Column) -> Column:
    """Codes one answer contributes, before the column-wide number rule.

    List items are taken as they are, digit strings are kept, any other text
    counts as ``NULL``; numbers are cut to whole ones.
    """
    return (
        F.when(answer["kind"] == "list", answer["items"])
        .when(answer["kind"] == "number", F.array(whole_number_text(answer["num"])))
        .when((answer["kind"] == "text") & is_digits(answer["txt"]), F.array(answer["txt"]))
        .otherwise(F.array(F.lit(NULL_CODE)))
    )


def percentage(n: Column, base: Column) -> Column:
    """Share of ``base`` in percent, one decimal, halves to even; 0 on an empty base."""
    share = F.when(base > 0, n / base * F.lit(100.0)).otherwise(F.lit(0.0))
    return F.rint(share * 10) / 10


def percentage_text(pct: Column) -> Column:
    return F.concat(pct.cast("string"), F.lit("%"))

"""Similarity of names: share of characters in a longest common subsequence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_WEIGHT = 0.2
LAST_WEIGHT = 0.8

# A 64-bit word holds one flag per character and one carry bit.
WORD_CHARS = 60


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _flag(places: Column) -> Column:
    """A word with the one flag set that is ``places`` from the right."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), places)


def _lcs_in_a_word(a: Column, b: Column) -> Column:
    """Bit-vector recurrence: a cleared flag marks a matched character of ``a``."""
    full = _flag(F.length(a)) - 1
    letters = _chars(a)

    def places(letter):
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))),
            F.lit(0).cast("bigint"),
            lambda acc, i: F.when(
                F.get(letters, i - 1) == letter,
                acc.bitwiseOR(_flag(i - 1)),
            ).otherwise(acc),
        )

    def step(flags, letter):
        hit = flags.bitwiseAND(places(letter))
        return (flags + hit).bitwiseOR(flags - hit).bitwiseAND(full)

    return F.length(a) - F.bit_count(F.aggregate(_chars(b), full, step))


def _lcs_by_rows(a: Column, b: Column) -> Column:
    """Table recurrence kept one row at a time, for texts longer than a word."""
    other = _chars(b)
    width = F.length(b)
    start = F.array_repeat(F.lit(0), width + 1)

    def next_row(row, letter):
        return F.aggregate(
            F.sequence(F.lit(1), width),
            F.array(F.lit(0)),
            lambda new, j: F.array_append(
                new,
                F.when(F.get(other, j - 1) == letter, F.get(row, j - 1) + 1).otherwise(
                    F.greatest(F.get(row, j), F.get(new, j - 1))
                ),
            ),
        )

    return F.element_at(F.aggregate(_chars(a), start, next_row), -1)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence."""
    return (
        F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0))
        .when(a == b, F.length(a))
        .when(F.length(a) <= WORD_CHARS, _lcs_in_a_word(a, b))
        .otherwise(_lcs_by_rows(a, b))
        .cast("int")
    )


def ratio(a: Column, b: Column) -> Column:
    """Whole number 0..100; 100 for equal texts, both empty included."""
    total = F.length(a) + F.length(b)
    return (
        F.when(a == b, F.lit(100))
        .when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0))
        .otherwise(F.rint(F.lit(200.0) * lcs_length(a, b) / total).cast("int"))
    )


def name_match_score(first_a: Column, last_a: Column, first_b: Column, last_b: Column) -> Column:
    return ratio(first_a, first_b) * F.lit(FIRST_WEIGHT) + ratio(last_a, last_b) * F.lit(LAST_WEIGHT)

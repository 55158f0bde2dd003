"""Best fuzzy match of every left-over person, exactly and without a cross join.

Every left name gets the right name with the highest score, however low it is.
Comparing all pairs is avoided in three steps that never lose the best one:

1. Names are reduced to distinct (first, last); scores depend on nothing else.
2. An equi-join on last names with at most one letter deleted gives most left
   names a score that they are known to reach.
3. Names are laid out by how many vowels and other characters their last name
   has. Two counts bound the longest common subsequence, so a left name is
   sent only to those cells whose bound reaches its known score. A cell holds a
   bounded block of either side, scores it in Arrow batches, and gives back one
   row per left name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.scores import FIRST_WEIGHT, LAST_WEIGHT
from surveyloom.operators.matching import COHORTS, NAME, PAIRS
from surveyloom.session import checkpoint, ship_package

# Names per side in one cell.
LEFT_ROWS = 50_000
RIGHT_ROWS = 20_000

VOWELS = "[aeiou]"
# Guards comparisons of computed bounds against rounding.
SLACK = 1e-6
# Flags of one machine word, less the carry.
WORD_CHARS = 63
FIRST_SCORES_KEPT = 512

# ``pair`` tells apart several pairs of groups that are matched in one run.
PERSON = ["pair", *NAME]
# What decides the cells that a left name can find something in.
PROFILE = ["pair", "_v", "_o", "known"]
CELL = ["pair", "vowels", "others", "right_block", "left_block"]
CELL_SCHEMA = (
    "pair string, first string, last string, score double, "
    "right_first string, right_last string, right_id string"
)


# -- step 2: scores known to be reached ---------------------------------------

def _shortened(text: Column) -> Column:
    """The text itself and every text with one character deleted."""
    size = F.length(text)
    deleted = F.when(
        size > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(size, F.lit(1))),
            lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, size)),
        ),
    )
    return F.array_distinct(F.concat(F.array(text), F.coalesce(deleted, F.array().cast("array<string>"))))


def _probes(names: DataFrame) -> DataFrame:
    """Join keys of each name: shortened last names, alone and with the first name."""
    rests = names.select("*", F.explode(_shortened(F.col("last"))).alias("rest"))
    return rests.select("*", F.explode(F.array(F.lit(None).cast("string"), F.col("first"))).alias("_with")).withColumn(
        "with_first", F.coalesce(F.concat(F.lit("="), "_with"), F.lit(""))
    ).drop("_with")


def known_scores(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(pair, first, last, known)`` for left names that some right name surely scores with.

    Right names are summed up per key (only the shortest length matters), so a
    key shared by many names on both sides still joins to one row.
    """
    keys = ["pair", "rest", "with_first"]
    reach = _probes(right).groupBy(*keys).agg(F.min(F.length("last")).alias("size"))
    joined = _probes(left).join(reach, keys)
    total = F.length("last") + F.col("size")
    last_ratio = F.when(total == 0, F.lit(100.0)).otherwise(F.rint(F.lit(200.0) * F.length("rest") / total))
    first_ratio = F.when(F.col("with_first") != "", F.lit(100.0)).otherwise(F.lit(0.0))
    score = first_ratio * FIRST_WEIGHT + last_ratio * LAST_WEIGHT
    return joined.groupBy(*PERSON).agg(F.max(score).alias("known"))


# -- step 3: cells ------------------------------------------------------------

def _profile(last: Column) -> tuple[Column, Column]:
    vowels = F.length(last) - F.length(F.regexp_replace(last, VOWELS, ""))
    return vowels, F.length(last) - vowels


def _block_of(n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*NAME), n_blocks).cast("int")


def _fresh(columns: list[str]) -> list[Column]:
    """Columns as new ones: both sides may come from the same people."""
    return [F.col(c).alias(c) for c in columns]


def _meetings(left: DataFrame, layout: DataFrame, left_rows: int) -> DataFrame:
    """Which profiles of left names go to which right cells, and into how many blocks each side is split.

    Worked out on the profiles that exist, which are few, never on the names.
    """
    profiles = left.groupBy(*PROFILE).agg(F.count("*").alias("n"))
    common = F.least("_v", "vowels") + F.least("_o", "others")
    total = F.col("_v") + F.col("_o") + F.col("vowels") + F.col("others")
    bound = F.when(total == 0, F.lit(100.0)).otherwise(F.rint(F.lit(200.0) * common / total))
    reachable = bound * LAST_WEIGHT + 100 * FIRST_WEIGHT + SLACK >= F.col("known")
    met = checkpoint(profiles.join(layout, "pair").filter(reachable))
    cell = ["pair", "vowels", "others"]
    blocks = met.groupBy(*cell).agg(F.ceil(F.sum("n") / left_rows).cast("int").alias("n_left_blocks"))
    return met.drop("n").join(blocks, cell)


def _left_cells(left: DataFrame, meetings: DataFrame) -> DataFrame:
    """Left names, once for every right block that may hold something good enough."""
    return (
        left.join(meetings, PROFILE)
        .withColumn("left_block", _block_of(F.col("n_left_blocks")))
        .withColumn("right_block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(*_fresh([*CELL, *NAME, "known"]))
    )


def _right_cells(right: DataFrame, meetings: DataFrame) -> DataFrame:
    """Right names of the cells that are met, once for every left block of the cell."""
    vowels, others = _profile(F.col("last"))
    cells = meetings.select("pair", "vowels", "others", "n_blocks", "n_left_blocks").distinct()
    return (
        right.withColumns({"vowels": vowels, "others": others})
        .join(cells, ["pair", "vowels", "others"])
        .withColumn("right_block", _block_of(F.col("n_blocks")))
        .withColumn("left_block", F.explode(F.sequence(F.lit(0), F.col("n_left_blocks") - 1)))
        .select(*_fresh([*CELL, *NAME, "right_id"]))
    )


class _Texts:
    """Distinct texts of a block as a matrix of character numbers, 0 where a text has ended."""

    def __init__(self, texts: pd.Series):
        self.index, distinct = pd.factorize(texts)
        self.texts = list(distinct)
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        numbers: dict[str, int] = {}
        self.matrix = np.zeros((len(self.texts), int(self.sizes.max(initial=0))), dtype=np.int32)
        for row, text in enumerate(self.texts):
            self.matrix[row, : len(text)] = [numbers.setdefault(ch, len(numbers) + 1) for ch in text]
        self.numbers = numbers

    def common(self, text: str) -> np.ndarray:
        """Longest-common-subsequence length of ``text`` with every distinct text."""
        if len(text) > WORD_CHARS:
            return np.array([_common_of_two(text, other) for other in self.texts], dtype=np.int64)
        places = np.zeros(len(self.numbers) + 1, dtype=np.uint64)
        for i, ch in enumerate(text):
            if ch in self.numbers:
                places[self.numbers[ch]] |= np.uint64(1 << i)
        full = np.uint64((1 << len(text)) - 1)
        flags = np.full(len(self.texts), full, dtype=np.uint64)
        for column in self.matrix.T:
            hit = flags & places[column]
            flags = ((flags + hit) | (flags - hit)) & full
        return len(text) - np.bitwise_count(flags).astype(np.int64)

    def ratios(self, text: str) -> np.ndarray:
        total = self.sizes + len(text)
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.rint(200.0 * self.common(text) / total)
        return np.where(total == 0, 100.0, share)


def _common_of_two(text: str, other: str) -> int:
    full = (1 << len(text)) - 1
    places: dict[str, int] = {}
    for i, ch in enumerate(text):
        places[ch] = places.get(ch, 0) | (1 << i)
    flags = full
    for ch in other:
        hit = flags & places.get(ch, 0)
        flags = ((flags + hit) | (flags - hit)) & full
    return len(text) - flags.bit_count()


def best_in_cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Best right name of the cell for each left name that has one good enough."""
    if left.empty or right.empty:
        return _found_rows([])
    pair = left["pair"].iloc[0]
    # The first of equally good names wins, so keep them in that order.
    right = right.sort_values([*NAME, "right_id"], ignore_index=True)
    firsts, lasts = _Texts(right["first"]), _Texts(right["last"])
    first_ratios: dict[str, np.ndarray] = {}
    found = []
    for last, group in left.groupby("last", sort=False):
        by_last = lasts.ratios(last) * LAST_WEIGHT
        for first, known in zip(group["first"], group["known"]):
            good = by_last + 100 * FIRST_WEIGHT + SLACK >= known
            rows = np.flatnonzero(good[lasts.index])
            if not len(rows):
                continue
            if first not in first_ratios:
                if len(first_ratios) >= FIRST_SCORES_KEPT:
                    first_ratios.clear()
                first_ratios[first] = firsts.ratios(first) * FIRST_WEIGHT
            scores = first_ratios[first][firsts.index[rows]] + by_last[lasts.index[rows]]
            at = int(np.argmax(scores))
            best = right.iloc[rows[at]]
            found.append((pair, first, last, scores[at], best["first"], best["last"], best["right_id"]))
    return _found_rows(found)


def _found_rows(found: list[tuple]) -> pd.DataFrame:
    """Rows in the layout of ``CELL_SCHEMA``, with its types even when there are none."""
    names = CELL_SCHEMA.replace(" string", "").replace(" double", "").split(", ")
    rows = pd.DataFrame(found, columns=names, dtype="object")
    return rows.astype({"score": "float64"})


def best_names(
    left: DataFrame, right: DataFrame, left_rows: int = LEFT_ROWS, right_rows: int = RIGHT_ROWS
) -> DataFrame:
    """``(pair, first, last, score, right_first, right_last, right_id)`` per distinct left name.

    Both sides carry ``pair``. The distinct names are used several times and
    their number sets the layout, so they are put on reliable storage first.
    """
    left_names = checkpoint(left.select(*PERSON).distinct())
    right_names = checkpoint(right.groupBy(*PERSON).agg(F.min("response_id").alias("right_id")))
    vowels, others = _profile(F.col("last"))
    layout = (
        right_names.groupBy("pair", vowels.alias("vowels"), others.alias("others"))
        .agg(F.ceil(F.count("*") / right_rows).cast("int").alias("n_blocks"))
    )
    ship_package(left.sparkSession)
    known = left_names.join(known_scores(left_names, right_names), PERSON, "left").fillna(-1.0, ["known"])
    scored = checkpoint(known.withColumns(dict(zip(("_v", "_o"), (vowels, others)))))
    meetings = _meetings(scored, layout, left_rows)
    cells = (
        _left_cells(scored, meetings)
        .groupBy(*CELL)
        .cogroup(_right_cells(right_names, meetings).groupBy(*CELL))
        .applyInPandas(lambda l, r: best_in_cell(l, r), CELL_SCHEMA)
    )
    best = F.min(
        F.struct((-F.col("score")).alias("minus"), "right_first", "right_last", "right_id")
    )
    return cells.groupBy(*PERSON).agg(best.alias("b")).select(
        *PERSON, (-F.col("b.minus")).alias("score"), "b.right_first", "b.right_last", "b.right_id"
    )


def _best_of(left: DataFrame, right: DataFrame, **sizes: int) -> DataFrame:
    """Left people with their best right one: ``(pair, response_id, first, last, b_*)``."""
    best = best_names(left, right, **sizes)
    return left.select("response_id", *PERSON).join(best, PERSON, "left")


def fuzzy_best_match(
    left: DataFrame, right: DataFrame, left_label: str, right_label: str, **sizes: int
) -> DataFrame:
    """For each left person the best right one, or nulls when there is no right person.

    A right person may be the best of many left ones.
    """
    one_pair = F.lit("")
    matched = _best_of(left.withColumn("pair", one_pair), right.withColumn("pair", one_pair), **sizes)
    return matched.select(
        F.col("response_id").alias(f"{left_label}_id"),
        F.col("first").alias(f"{left_label}_first"),
        F.col("last").alias(f"{left_label}_last"),
        F.col("right_id").alias(f"{right_label}_id"),
        F.col("right_first").alias(f"{right_label}_first"),
        F.col("right_last").alias(f"{right_label}_last"),
        F.col("score").alias("match_score"),
    )


def fuzzy_candidates(leftovers: DataFrame, **sizes: int) -> DataFrame:
    """Best matches for all three cohort pairs in one run, as rows of the match table."""
    def side(place: int) -> DataFrame:
        pairs = F.array(
            *[F.when(F.col("cohort") == p[place], F.lit(f"{p[0]}-{p[1]}")) for p in PAIRS]
        )
        return leftovers.withColumn("pair", F.explode(F.array_compact(pairs)))

    matched = _best_of(side(0), side(1), **sizes)
    label = F.split("pair", "-")
    columns = []
    for c in COHORTS:
        for part, left_part in (("id", "response_id"), ("first", "first"), ("last", "last")):
            value = F.when(label[0] == c, F.col(left_part)).when(label[1] == c, F.col(f"right_{part}"))
            columns.append(value.alias(f"{c}_{part}"))
    return matched.select(*columns, F.col("score").alias("match_score"))

"""Identity of respondents across cohorts: clean, deduplicate, match, link.

People rows are ``(response_id, first, last, cohort, recorded_at, marker, ...)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.answers import answer_text, answer_to, has_answer
from surveyloom.functions.text import clean_name, is_placeholder_name
from surveyloom.operators.numbering import number_rows

COHORTS = ("pre", "post", "unsure")
# Fixed order in which cohorts are paired.
PAIRS = (("pre", "post"), ("pre", "unsure"), ("post", "unsure"))
NAME = ["first", "last"]


def people_from_responses(
    responses: DataFrame, first_column: str, last_column: str, marker_column: str
) -> DataFrame:
    """Name and marker answers of each response, beside its other columns."""
    def text(column_id):
        return answer_text(answer_to(F.col("answers"), column_id))

    return responses.withColumns(
        {
            "first": text(first_column),
            "last": text(last_column),
            "marker": has_answer(answer_to(F.col("answers"), marker_column)),
        }
    )


def clean_names(people: DataFrame) -> DataFrame:
    """Both names in comparable form.

    Going through ``explode`` keeps later filters and keys from being rewritten
    in terms of the raw names, which would clean each name again for each use.
    """
    names = F.struct(clean_name(F.col("first")).alias("first"), clean_name(F.col("last")).alias("last"))
    return people.withColumn("_name", F.explode(F.array(names))).withColumns(
        {part: F.col("_name")[part] for part in NAME}
    ).drop("_name")


def drop_test_names(
    people: DataFrame, excluded: DataFrame | Iterable[tuple[str, str]] | None = None
) -> DataFrame:
    """Clean both names, then drop people whose names are both placeholders.

    ``excluded`` lists further (first, last) pairs to drop.
    """
    cleaned = clean_names(people)
    kept = cleaned.filter(
        ~(is_placeholder_name(F.col("first")) & is_placeholder_name(F.col("last")))
    )
    if excluded is None:
        return kept
    if isinstance(excluded, DataFrame):
        return kept.join(excluded.select(*NAME), NAME, "left_anti")
    # Cleaned names hold letters and blanks only, so the bar tells the two apart.
    return kept.filter(~F.concat_ws("|", *NAME).isin(["|".join(pair) for pair in excluded]))


def latest_valid_per_name(people: DataFrame, keys: Sequence[str] = ("cohort", "first", "last")) -> DataFrame:
    """One row per name: the latest with a marker answer, else the latest at all.

    Kept as a maximum over narrow columns, which is combined before the
    shuffle, so a name that many rows share is no hot spot. Equal dates are
    settled by response id, which a name has once.
    """
    order = F.struct(F.col("marker"), F.col("recorded_at"), F.col("response_id"))
    best = people.groupBy(*keys).agg(F.max(order)["response_id"].alias("response_id"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "response_id")]
    return people.alias("p").join(best.alias("b"), reduce(and_, same), "left_semi").select(*people.columns)


def cohort(people: DataFrame, name: str) -> DataFrame:
    return people.filter(F.col("cohort") == name)


def _side(people: DataFrame, label: str) -> DataFrame:
    return people.select(*NAME, F.col("response_id").alias(f"{label}_id"))


def exact_match(
    left: DataFrame, right: DataFrame, left_label: str, right_label: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs with equal names (score 100), and what is left over on each side.

    Names are unique on each side after ``latest_valid_per_name``.
    """
    joined = _side(left, left_label).join(_side(right, right_label), NAME)
    matched = match_rows(joined, F.col(f"{left_label}_id"), F.col(f"{right_label}_id"), left_label, right_label)
    return (
        matched,
        left.join(right.select(*NAME).distinct(), NAME, "left_anti").select(*left.columns),
        right.join(left.select(*NAME).distinct(), NAME, "left_anti").select(*right.columns),
    )


def match_rows(joined: DataFrame, left_id, right_id, left_label: str, right_label: str) -> DataFrame:
    """Match-table rows for pairs that share ``first`` and ``last``."""
    ids = {left_label: left_id, right_label: right_id}
    columns = []
    for c in COHORTS:
        known = c in ids
        columns += [
            (ids[c] if known else F.lit(None)).cast("string").alias(f"{c}_id"),
            (F.col("first") if known else F.lit(None)).cast("string").alias(f"{c}_first"),
            (F.col("last") if known else F.lit(None)).cast("string").alias(f"{c}_last"),
        ]
    return joined.select(*columns, F.lit(100.0).alias("match_score"))


def exact_match_pre_post(pre: DataFrame, post: DataFrame):
    return exact_match(pre, post, "pre", "post")


def exact_match_pre_unsure(pre: DataFrame, unsure: DataFrame):
    return exact_match(pre, unsure, "pre", "unsure")


def exact_match_post_unsure(post: DataFrame, unsure: DataFrame):
    return exact_match(post, unsure, "post", "unsure")


def cascade_stages(people: DataFrame) -> DataFrame:
    """Per name the response of each cohort and the stage that links two of them.

    Pre and post go together first, then pre and unsure, then post and unsure.
    As a name occurs once per cohort, that order is a choice within one group.
    """
    ids = people.groupBy(*NAME).agg(
        *[F.max(F.when(F.col("cohort") == c, F.col("response_id"))).alias(f"{c}_id") for c in COHORTS]
    )
    stage = F.lit(None).cast("int")
    for number, (a, b) in reversed(list(enumerate(PAIRS, start=1))):
        stage = F.when(F.col(f"{a}_id").isNotNull() & F.col(f"{b}_id").isNotNull(), number).otherwise(stage)
    return ids.withColumn("stage", stage)


def match_cascade(people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All exact matches with their stage, and the people left over, in one shuffle."""
    staged = cascade_stages(people)
    used = {c: [i for i, pair in enumerate(PAIRS, start=1) if c in pair] for c in COHORTS}

    def linked(c: str) -> Column:
        return F.coalesce(F.col("stage").isin(*used[c]), F.lit(False))

    columns = []
    for c in COHORTS:
        columns.append(F.when(linked(c), F.col(f"{c}_id")).alias(f"{c}_id"))
        columns += [F.when(linked(c), F.col(part)).alias(f"{c}_{part}") for part in NAME]
    matches = staged.filter(F.col("stage").isNotNull()).select(
        "stage", *columns, F.lit(100.0).alias("match_score")
    )
    left = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("cohort"),
                    F.when(~linked(c), F.col(f"{c}_id")).alias("response_id"),
                )
                for c in COHORTS
            ]
        ),
        lambda x: x["response_id"].isNotNull(),
    )
    leftovers = staged.select(*NAME, F.explode(left).alias("x")).select(
        "x.cohort", "x.response_id", *NAME
    )
    return matches, leftovers


def confirm_matches(
    matches: DataFrame, candidates: DataFrame, leftovers: DataFrame, confirmations: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move the candidates a reviewer confirmed into the matches.

    ``confirmations`` names them by ``(pre_id, post_id, unsure_id)``; unknown
    ones do nothing. Their people leave the leftovers, other candidates with
    the same people stay. Returns (matches, candidates, leftovers).
    """
    ids = [f"{c}_id" for c in COHORTS]
    known = confirmations.select(*[F.col(i).cast("string").alias(i) for i in ids]).distinct()
    keyed = [F.coalesce(F.col(i), F.lit("")).alias(f"_{i}") for i in ids]
    keys = known.select(*keyed)
    named = candidates.select("*", *keyed)
    on = [f"_{i}" for i in ids]
    confirmed = named.join(keys, on, "left_semi").drop(*on)
    remaining = named.join(keys, on, "left_anti").drop(*on)
    moved = confirmed.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("cohort"), F.col(f"{c}_id").alias("response_id")) for c in COHORTS])
        ).alias("x")
    ).select("x.*").distinct()
    extended = matches.unionByName(
        confirmed.select(*[c for c in matches.columns if c in confirmed.columns]),
        allowMissingColumns=True,
    )
    return extended, remaining, leftovers.join(moved, ["cohort", "response_id"], "left_anti")


def match_key() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(f"{c}_id"), F.lit("")) for c in COHORTS])


def match_ids(matches: DataFrame, hashed: bool = False) -> DataFrame:
    """``match_id`` 1..n by stage, then name, then ids.

    ``hashed`` gives an id from the linked responses instead, without any order.
    """
    if hashed:
        return matches.withColumn("match_id", F.xxhash64(match_key()))
    first = F.coalesce(*[F.col(f"{c}_first") for c in COHORTS])
    last = F.coalesce(*[F.col(f"{c}_last") for c in COHORTS])
    stage = F.coalesce("stage", F.lit(len(PAIRS) + 1)) if "stage" in matches.columns else F.lit(0)
    return number_rows(matches, [stage, first, last, match_key()], "match_id")


def side_of_matches(matches: DataFrame, people: DataFrame, side: str) -> DataFrame:
    """The person standing for ``side`` (pre or post) in each match, ``match_id`` first.

    Without a person of that cohort the unsure one stands in; a match whose
    person is not found keeps its id and nothing else.
    """
    own, stand_in = F.col(f"{side}_id"), F.col("unsure_id")
    wanted = matches.select(
        "match_id",
        F.when(own.isNotNull(), side).otherwise("unsure").alias("cohort"),
        F.coalesce(own, stand_in).alias("response_id"),
    )
    rest = [c for c in people.columns if c not in ("cohort", "response_id")]
    found = people.filter(F.col("cohort").isin(side, "unsure")).withColumn("_found", F.lit(True))
    joined = wanted.join(found, ["cohort", "response_id"], "left")
    present = F.col("_found")
    return joined.select(
        "match_id",
        F.when(present, F.col("cohort")).alias("cohort"),
        F.when(present, F.col("response_id")).alias("response_id"),
        *rest,
    )


def pre_side(matches: DataFrame, people: DataFrame) -> DataFrame:
    return side_of_matches(matches, people, "pre")


def post_side(matches: DataFrame, people: DataFrame) -> DataFrame:
    return side_of_matches(matches, people, "post")

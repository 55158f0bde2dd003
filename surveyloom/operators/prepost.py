"""Pre/post tables: both phases are counted in the same pass, not joined afterwards."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators import frequency as freq
from surveyloom.operators.filters import REPORTABLE, regional_nonzero

MEASURES = ["pre_n", "post_n"]
SHARES = [("pre_pct", "pre_frequency"), ("post_pct", "post_frequency")]


def phase_tally(phased: DataFrame) -> DataFrame:
    phase = F.col("phase")
    return freq.tally(phased, {"pre_n": phase == "pre", "post_n": phase == "post"})


def _given(tallied: DataFrame, questions: DataFrame, apart: bool) -> DataFrame:
    stats = freq.column_stats(tallied, questions, MEASURES)
    return freq.given_codes(tallied, stats, MEASURES, apart)


def _with_shares(table: DataFrame, tallied: DataFrame) -> DataFrame:
    """Percentages of the respondents of each phase; 0 where a phase has none."""
    return _shares(table.join(freq.bases(tallied, MEASURES), "survey_id"))


def _shares(table: DataFrame) -> DataFrame:
    return table.withColumns(freq.shares(MEASURES, SHARES)).drop(*[f"base_{m}" for m in MEASURES])


def pre_post_mc(
    phased: DataFrame, questions: DataFrame, choices: DataFrame, apart: bool = False
) -> DataFrame:
    """Choice questions: code, label, count and share in each phase.

    ``apart`` when the phases come from different surveys, so that each decides
    for itself whether a column is numeric.
    """
    tallied = phase_tally(phased)
    given = _given(tallied, questions, apart)
    return _with_shares(freq.labelled(given, freq.offered_for(choices, questions), MEASURES), tallied)


def pre_post_numeric(phased: DataFrame, questions: DataFrame, apart: bool = False) -> DataFrame:
    """Numeric questions: value, count and share in each phase."""
    tallied = phase_tally(phased)
    counts = _given(tallied, questions, apart).groupBy(*freq.KEYS, F.col("code").alias("value")).agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )
    return _with_shares(counts, tallied)


def pre_post_report(
    phased: DataFrame,
    questions: DataFrame,
    choices: DataFrame,
    regional: Iterable[str] = (),
    apart: bool = False,
) -> DataFrame:
    """Pre/post tables of every reportable question of every survey."""
    tallied = phase_tally(phased)
    reported = freq.of_type(questions, *REPORTABLE)
    offered = freq.offered_for(choices, freq.of_type(questions, "MultipleChoice"))
    table = freq.labelled(_given(tallied, reported, apart), offered, MEASURES)
    result = _shares(freq.described(table, tallied, reported, MEASURES))
    return regional_nonzero(result, regional, MEASURES) if regional else result


def questions_of_both(pre: DataFrame, post: DataFrame, survey_id: str) -> DataFrame:
    """Questions of two surveys under one id, described as the first does that has them.

    ``asked_pre_n`` and ``asked_post_n`` tell which survey asks them: a question
    only one asks is not skipped by the other's respondents.
    """
    sides = [
        frame.withColumn("survey_id", F.lit(survey_id)).withColumns(
            {"asked_pre_n": F.lit(phase == "pre"), "asked_post_n": F.lit(phase == "post")}
        )
        for frame, phase in ((pre, "pre"), (post, "post"))
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    about = [c for c in both.columns if c not in (*freq.KEYS, "asked_pre_n", "asked_post_n")]
    # One row for each question and survey.
    return both.groupBy(*freq.KEYS).agg(
        F.max_by(F.struct(*about), "asked_pre_n").alias("about"), F.max("asked_pre_n").alias("asked_pre_n"), F.max("asked_post_n").alias("asked_post_n")
    ).select(*freq.KEYS, "about.*", "asked_pre_n", "asked_post_n")


def choices_of_both(pre: DataFrame, post: DataFrame, survey_id: str) -> DataFrame:
    """Offered answers of two surveys under one id; a code both offer is labelled as the first does."""
    sides = [
        frame.withColumn("survey_id", F.lit(survey_id)).withColumn("_first", F.lit(phase == "pre"))
        for frame, phase in ((pre, "pre"), (post, "post"))
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    keys = [*freq.KEYS, "answer_id"]
    about = [c for c in both.columns if c not in (*keys, "_first")]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*about), "_first").alias("about")).select(*keys, "about.*")


def as_phase(responses: DataFrame, survey_id: str, phase: str) -> DataFrame:
    """Responses as one phase of a comparison under the id ``survey_id``."""
    return responses.withColumn("survey_id", F.lit(survey_id)).withColumn("phase", F.lit(phase))

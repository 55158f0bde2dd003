"""Frequency tables of every question of every survey in one pass.

Responses are read and shuffled once: counted map-side by (survey, column,
kind, code), and the counts put on reliable storage. Everything after that
works on counts, whose number depends on the questions and not on how many
people answered them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.answers import NULL_CODE, codes, percentage, percentage_text
from surveyloom.operators.filters import REPORTABLE, regional_nonzero
from surveyloom.session import checkpoint

# Kind of the row that stands for a respondent; its ``column_id`` is empty.
RESPONDENT = "respondent"
KEYS = ["survey_id", "column_id"]
# What is counted: name -> which responses; None for all.
ALL: Mapping[str, Column | None] = {"n": None}

CHART_ROWS = 10


def counted_rows(responses: DataFrame) -> DataFrame:
    """What is counted, one row each: every code, every list, every respondent.

    A list adds a row without code, so that lists can be counted as well as
    what they hold; a respondent is a row without answer.
    """
    rows = responses.withColumn("a", F.explode(F.array_append("answers", F.lit(None))))
    answer = F.col("a")
    listed = (
        F.when(answer.isNull(), F.array(F.lit(None).cast("string")))
        .when(answer["kind"] == "list", F.array_append(F.array_compact(answer["items"]), F.lit(None)))
        .otherwise(codes(answer))
    )
    return rows.select(
        "*",
        F.coalesce(answer["column_id"], F.lit("")).alias("column_id"),
        F.coalesce(answer["kind"], F.lit(RESPONDENT)).alias("kind"),
        F.explode(listed).alias("code"),
    )


def tally(responses: DataFrame, measures: Mapping[str, Column | None] = ALL) -> DataFrame:
    """``(survey_id, column_id, kind, code, measures)`` - the one shuffle of response data.

    The counts are read several times below; the checkpoint makes sure that the
    responses are not.
    """
    counts = [
        (F.count("*") if which is None else F.count_if(which)).alias(name)
        for name, which in measures.items()
    ]
    return checkpoint(counted_rows(responses).groupBy(*KEYS, "kind", "code").agg(*counts))


def _total(measures: Iterable[str]) -> Column:
    first, *rest = [F.col(m) for m in measures]
    for more in rest:
        first = first + more
    return first


def bases(tallied: DataFrame, measures: Sequence[str] = ("n",)) -> DataFrame:
    """Respondents per survey: what percentages are taken of."""
    return tallied.groupBy("survey_id").agg(
        *[F.sum(F.when(F.col("kind") == RESPONDENT, F.col(m)).otherwise(0)).alias(f"base_{m}") for m in measures]
    )


def column_stats(tallied: DataFrame, questions: DataFrame, measures: Sequence[str] = ("n",)) -> DataFrame:
    """Per question: respondents, how many of them answered, and the kinds of its answers.

    ``questions`` may say in ``asked_<m>`` whether a measure's respondents were asked.
    ``numeric_<m>`` tells whether all answers behind that measure are numbers.
    """
    kind = F.col("kind")
    is_answer = (kind != "list") | F.col("code").isNull()
    totals = tallied.groupBy(*KEYS).agg(
        *[F.sum(F.when(is_answer, F.col(m)).otherwise(0)).alias(f"answered_{m}") for m in measures],
        *[F.min(F.when(F.col(m) > 0, kind == "number")).alias(f"numeric_{m}") for m in measures],
        F.min(kind == "number").alias("numeric"),
        F.min(kind == "bool").alias("boolean"),
    )
    # A question is asked of every respondent, unless the dimension says of whom.
    of_whom = [
        F.max(f"asked_{m}" if f"asked_{m}" in questions.columns else F.lit(True)).alias(f"asked_{m}") for m in measures
    ]
    asked = questions.groupBy(*KEYS).agg(*of_whom)
    joined = asked.join(bases(tallied, measures), "survey_id").join(totals, KEYS, "left")
    return joined.fillna(0, [f"answered_{m}" for m in measures])


def seen_codes(
    tallied: DataFrame, stats: DataFrame, measures: Sequence[str] = ("n",), apart: bool = False
) -> DataFrame:
    """Codes given, ``(survey_id, column_id, code, measures)``; not grouped yet.

    Numbers keep their own code only in a column of nothing but numbers; among
    texts or lists they count as ``NULL``. A column that everyone answered with
    a boolean gives no codes. With ``apart`` each measure's answers decide by
    themselves whether their column is numeric.
    """
    base = _total(f"base_{m}" for m in measures)
    answered = _total(f"answered_{m}" for m in measures)
    only_bool = F.col("boolean") & (base == answered)

    def final(numeric: str) -> Column:
        return F.when((F.col("kind") == "number") & ~F.col(numeric), F.lit(NULL_CODE)).otherwise(F.col("code"))

    rows = tallied.join(stats, KEYS).filter(F.col("code").isNotNull() & ~only_bool)
    if not apart:
        return rows.select(*KEYS, final("numeric").alias("code"), *measures)
    split = F.array(
        *[
            F.struct(
                final(f"numeric_{m}").alias("code"),
                *[(F.col(o) if o == m else F.lit(0).cast("bigint")).alias(o) for o in measures],
            )
            for m in measures
        ]
    )
    return rows.select(*KEYS, F.explode(split).alias("r")).select(*KEYS, "r.*").filter(_total(measures) > 0)


def skipped(stats: DataFrame, measures: Sequence[str] = ("n",)) -> DataFrame:
    """Answers not given by those who were asked, under the code ``NULL``; only where there are any."""
    return stats.select(
        *KEYS,
        F.lit(NULL_CODE).alias("code"),
        *[F.when(F.col(f"asked_{m}"), F.col(f"base_{m}") - F.col(f"answered_{m}")).otherwise(0).alias(m) for m in measures],
    ).filter(_total(measures) > 0)


def given_codes(
    tallied: DataFrame, stats: DataFrame, measures: Sequence[str] = ("n",), apart: bool = False
) -> DataFrame:
    """All codes of the questions, skipped answers included; not grouped yet."""
    return seen_codes(tallied, stats, measures, apart).unionByName(skipped(stats, measures))


def normalise_answers(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Count of each code of every question, skipped answers under ``NULL``."""
    tallied = tally(responses)
    given = given_codes(tallied, column_stats(tallied, questions))
    return given.groupBy(*KEYS, "code").agg(F.sum("n").alias("n"))


def labelled(given: DataFrame, choices: DataFrame, measures: Sequence[str] = ("n",)) -> DataFrame:
    """Full outer join of code counts and choices.

    Choices are unique per (survey, column, code), so stacking both sides and
    grouping gives the same rows with one shuffle and also finishes the counts.
    Options never chosen get 0, codes never offered an empty label.
    """
    offered = choices.select(
        *KEYS,
        F.col("answer_id").cast("string").alias("code"),
        F.col("question_value").cast("string").alias("value"),
        *[F.lit(0).cast("bigint").alias(m) for m in measures],
    )
    return offered.unionByName(given, allowMissingColumns=True).groupBy(*KEYS, "code").agg(
        F.coalesce(F.max("value"), F.lit("")).alias("value"), *[F.sum(m).alias(m) for m in measures]
    )


def of_type(questions: DataFrame, *data_types: str) -> DataFrame:
    return questions.filter(F.col("data_type").isin(*data_types))


def offered_for(choices: DataFrame, questions: DataFrame) -> DataFrame:
    """Choices of the given questions."""
    return choices.join(questions.select(*KEYS).distinct(), KEYS, "left_semi")


def shares(measures: Sequence[str], names: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """Percentage columns: per measure the names of the number and of its text."""
    columns = {}
    for measure, (number, text) in zip(measures, names):
        pct = percentage(F.col(measure), F.col(f"base_{measure}"))
        columns |= {number: pct, text: percentage_text(pct)}
    return columns


def _with_shares(table: DataFrame, tallied: DataFrame) -> DataFrame:
    return (
        table.join(bases(tallied), "survey_id")
        .withColumns(shares(["n"], [("pct", "frequency")]))
        .drop("base_n")
    )


def frequency_mc(responses: DataFrame, questions: DataFrame, choices: DataFrame) -> DataFrame:
    """``(survey_id, column_id, code, value, n, pct, frequency)`` for the given questions."""
    tallied = tally(responses)
    given = given_codes(tallied, column_stats(tallied, questions))
    return _with_shares(labelled(given, offered_for(choices, questions)), tallied)


def frequency_numeric(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """``(survey_id, column_id, value, n, pct, frequency)``; the value labels itself."""
    tallied = tally(responses)
    given = given_codes(tallied, column_stats(tallied, questions))
    counts = given.groupBy(*KEYS, F.col("code").alias("value")).agg(F.sum("n").alias("n"))
    return _with_shares(counts, tallied)


def frequency_numeric_labelled(
    responses: DataFrame, questions: DataFrame, choices: DataFrame
) -> DataFrame:
    """Numeric table under choice labels; rows of unlisted values stay apart, unlabelled."""
    return frequency_mc(responses, questions, choices).drop("code")


def described(
    table: DataFrame, tallied: DataFrame, questions: DataFrame, measures: Sequence[str]
) -> DataFrame:
    """Question columns and bases beside the counts; a numeric value is its own label."""
    about = questions.join(bases(tallied, measures), "survey_id").select(
        *KEYS, "block_name", "flow_pos", "data_type", "question_name", "question_text",
        F.concat_ws(": ", "question_name", "question_text").alias("heading"),
        *[f"base_{m}" for m in measures],
    )
    value = F.when(F.col("data_type") == "Numeric", F.col("code")).otherwise(F.col("value"))
    return table.join(about, KEYS).withColumn("value", value)


def survey_frequency(
    responses: DataFrame,
    questions: DataFrame,
    choices: DataFrame,
    regional: Iterable[str] = (),
) -> DataFrame:
    """The frequency report of all surveys as one table.

    MultipleChoice questions come with their offered choices, Numeric ones with
    the values seen.
    """
    reported = of_type(questions, *REPORTABLE)
    tallied = tally(responses)
    given = given_codes(tallied, column_stats(tallied, reported))
    table = labelled(given, offered_for(choices, of_type(questions, "MultipleChoice")))
    result = (
        described(table, tallied, reported, ["n"])
        .withColumns(shares(["n"], [("pct", "frequency")]))
        .drop("base_n")
    )
    return regional_nonzero(result, regional) if regional else result


def report_order(table: DataFrame) -> DataFrame:
    """Rows as a report prints them: numeric codes by size, others as text, NULL last."""
    numeric = F.when(F.col("data_type") == "Numeric", F.col("code").try_cast("double"))
    return table.orderBy("survey_id", "flow_pos", "column_id", numeric.asc_nulls_last(), "code")


def chart_series(table: DataFrame, limit: int = CHART_ROWS) -> DataFrame:
    """Rows of the tables short enough for a chart, with a flag on the NULL bar."""
    short = table.groupBy(*KEYS).agg(F.count("*").alias("bars")).filter(F.col("bars") < limit)
    return table.join(short.select(*KEYS), KEYS, "left_semi").withColumn(
        "is_null_bar", F.col("code") == NULL_CODE
    )

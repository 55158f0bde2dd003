"""Survey headers, item nonresponse and text counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.filters import free_text_questions
from surveyloom.session import checkpoint


def survey_header(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Per survey: responses, first and last day, whole days between, questions and their types."""
    span = responses.groupBy("survey_id").agg(
        F.count("*").alias("n_responses"),
        F.min("end_at").alias("first_at"),
        F.max("end_at").alias("last_at"),
    )
    # Types in order of first appearance: a survey has a handful of them.
    types = (
        questions.groupBy("survey_id", "question_type")
        .agg(F.min("flow_pos").alias("flow_pos"), F.count("*").alias("n"))
        .groupBy("survey_id")
        .agg(
            F.sum("n").alias("n_questions"),
            F.array_sort(F.collect_list(F.struct("flow_pos", "question_type"))).alias("types"),
        )
    )
    return span.join(types, "survey_id", "left").select(
        "survey_id",
        "n_responses",
        F.date_format("first_at", "yyyy-MM-dd").alias("first_response"),
        F.date_format("last_at", "yyyy-MM-dd").alias("last_response"),
        F.timestamp_diff("DAY", F.col("first_at"), F.col("last_at")).alias("duration_days"),
        F.coalesce("n_questions", F.lit(0)).alias("n_questions"),
        F.array_join(F.transform("types", lambda t: t["question_type"]), ", ").alias("question_types"),
    )


def missing_stats(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Missing and present answers per question, as counts and unrounded fractions.

    Counted in one pass; a respondent counts under the empty column. The counts
    are stored, since they are read both for the columns and for the base.
    """
    marked = responses.select(
        F.coalesce("survey_id", F.lit("")).alias("survey_id"),
        F.explode(
            F.concat(F.col("answers")["column_id"], F.array(F.lit("")))
        ).alias("column_id"),
    ).select("survey_id", F.coalesce("column_id", F.lit("")).alias("column_id"))
    counted = checkpoint(marked.groupBy("survey_id", "column_id").agg(F.count("*").alias("n")))
    bases = counted.groupBy("survey_id").agg(
        F.sum(F.when(F.col("column_id") == "", F.col("n")).otherwise(0)).alias("base")
    )
    asked = questions.select("survey_id", "column_id").distinct().join(bases, "survey_id")
    present = F.coalesce("n", F.lit(0))
    missing = F.col("base") - present
    fraction = missing / F.col("base")
    return asked.join(counted, ["survey_id", "column_id"], "left").select(
        "survey_id",
        "column_id",
        missing.alias("missing_n"),
        present.alias("present_n"),
        fraction.alias("missing_frc"),
        (F.lit(1.0) - fraction).alias("present_frc"),
    )


def free_text_compliance(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """``missing_stats`` of the FreeText questions."""
    return missing_stats(responses, free_text_questions(questions))


def text_entry_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Texts there are per column, before they go to translation."""
    return texts.groupBy("survey_id", "column_id").agg(F.count(text).alias("entries"))


def pre_post_header(phased: DataFrame) -> DataFrame:
    """Responses per survey and phase."""
    return phased.groupBy("survey_id", "phase").agg(F.count("*").alias("n_responses"))

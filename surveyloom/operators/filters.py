"""Row filters and projections over canonical responses and dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.functions.answers import answer_text, answer_to, codes

REPORTABLE = ("MultipleChoice", "Numeric")

# A dimension of up to so many bytes, measured as JSON, goes to every task.
BROADCAST_BYTES = 8 << 20
# Beyond that: responses of one survey that one task joins with its dimension.
ROWS_PER_SPLIT = 1 << 20
# Surveys that are split at most. A smaller one than these has less than a thousandth of all rows.
MOST_SPLIT = 1000


def literal_time(df: DataFrame, column: str, value: str | date | datetime) -> Column:
    """A UTC instant in the type of the column it is compared with.

    A plain date means midnight; a bound without a zone is UTC.
    """
    at = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    if at.tzinfo is None:
        at = at.replace(tzinfo=timezone.utc)
    text = at.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.to_timestamp(F.lit(text + "Z"))


def drop_preview(responses: DataFrame, channel: str = "channel") -> DataFrame:
    """Without preview responses; an unknown channel is kept."""
    return responses.filter(~F.col(channel).eqNullSafe(F.lit("preview")))


def splits_of(responses: DataFrame) -> dict[str, int]:
    """The surveys with more responses than a task should hold, and into how many parts they go.

    Counts are combined before the shuffle, and only the largest surveys come
    to the driver. Whatever is found here changes the plan, never a result.
    """
    counts = responses.where(F.col("survey_id").isNotNull()).groupBy("survey_id").agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") > ROWS_PER_SPLIT).orderBy(F.desc("n"), "survey_id").limit(MOST_SPLIT)
    return {r["survey_id"]: -(-r["n"] // ROWS_PER_SPLIT) for r in hot.collect()}


def with_survey_dimension(
    responses: DataFrame, dimension: DataFrame, how: str = "inner", splits: Mapping[str, int] | None = None
) -> DataFrame:
    """Join one dimension row per survey to the responses.

    The dimension is measured first. A small one is broadcast, so responses stay
    where they are. For a larger one surveys are dealt to as many join keys as
    their responses need (``splits``, counted here if not given), so one with a
    third of all responses spreads over its share of the tasks.
    """
    held = dimension.agg(F.sum(F.octet_length(F.to_json(F.struct(*dimension.columns))))).first()[0] or 0
    if splits is None and held <= BROADCAST_BYTES:
        return responses.join(F.broadcast(dimension), "survey_id", how)
    splits = splits_of(responses) if splits is None else splits
    number = F.lit(1)
    if splits:
        listed = F.create_map(*[F.lit(x) for pair in splits.items() for x in pair])
        number = F.coalesce(F.try_element_at(listed, F.col("survey_id")), F.lit(1))
    salt = F.coalesce(F.pmod(F.xxhash64("response_id"), number), F.lit(0)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), (number - 1).cast("int")))
    return (
        responses.withColumn("_salt", salt)
        .join(dimension.withColumn("_salt", salts), ["survey_id", "_salt"], how)
        .drop("_salt")
    )


def drop_all_null(
    responses: DataFrame, questions: DataFrame | None = None, data_types: Sequence[str] | None = None,
    splits: Mapping[str, int] | None = None,
) -> DataFrame:
    """Without responses that answer no question.

    With ``questions`` only columns in that dimension count as questions, and
    surveys without any are dropped. An empty list is an answer here. With
    ``data_types`` the responses that stay keep their answers to questions of
    these types alone, as one join serves both.
    """
    if questions is None:
        return responses.filter(F.size("answers") > 0)
    lists = {"_columns": F.lit(True)}
    if data_types is not None:
        lists["_kept"] = F.col("data_type").isin(*data_types)
    columns = questions.groupBy("survey_id").agg(
        *[F.collect_set(F.when(which, F.col("column_id"))).alias(name) for name, which in lists.items()]
    )
    joined = with_survey_dimension(responses, columns, splits=splits)
    kept = joined.filter(F.arrays_overlap(F.col("answers")["column_id"], F.col("_columns")))
    if data_types is not None:
        kept = kept.withColumn("answers", F.filter("answers", lambda a: F.array_contains("_kept", a["column_id"])))
    return kept.drop(*lists)


def date_range(
    responses: DataFrame, start, end, column: str = "recorded_at"
) -> DataFrame:
    """Both bounds included; a date bound stands for its midnight."""
    return responses.filter(
        F.col(column).between(literal_time(responses, column, start), literal_time(responses, column, end))
    )


def cutoff_split(responses: DataFrame, cutoff, column: str = "recorded_at") -> DataFrame:
    """``phase`` = pre up to the cutoff, post after it; undated responses are in neither."""
    if column not in responses.columns:
        raise ValueError(f"no column {column!r} to split on")
    at = literal_time(responses, column, cutoff)
    phase = F.when(F.col(column) <= at, "pre").when(F.col(column) > at, "post")
    return responses.withColumn("phase", phase).filter(F.col("phase").isNotNull())


def eligible_responses(
    responses: DataFrame, phase_column: str, min_progress: float = 82
) -> DataFrame:
    """Far enough through the survey, and the phase question answered."""
    return responses.filter(
        answer_to(F.col("answers"), phase_column).isNotNull() & (F.col("progress") > min_progress)
    )


def cohort_split(
    responses: DataFrame, code: Column, cohorts: Mapping[str, str] | None = None
) -> DataFrame:
    """``cohort`` from the phase code; other codes are dropped."""
    cohorts = cohorts or {"1": "pre", "4": "post", "5": "unsure"}
    cohort = F.lit(None).cast("string")
    for value, name in cohorts.items():
        cohort = F.when(code == value, name).otherwise(cohort)
    return responses.withColumn("cohort", cohort).filter(F.col("cohort").isNotNull())


def phase_code(column_id: str) -> Column:
    """Code given to the phase question, as text."""
    return F.get(codes(answer_to(F.col("answers"), column_id)), F.lit(0))


def select_questions(responses: DataFrame, column_ids: Sequence[str]) -> DataFrame:
    """Only the answers to the given columns, beside id and recording time."""
    return responses.select(
        "survey_id",
        "response_id",
        "recorded_at",
        F.filter("answers", lambda a: a["column_id"].isin(*column_ids)).alias("answers"),
    )


def regional_nonzero(
    table: DataFrame, texts: Iterable[str], counts: Sequence[str] = ("n",)
) -> DataFrame:
    """For the listed question texts, without the rows in which every count is zero."""
    some = F.lit(False)
    for count in counts:
        some = some | (F.col(count) != 0)
    return table.filter(~F.coalesce(F.col("question_text").isin(*texts), F.lit(False)) | some)


def parse_recorded_date(raw: Column) -> Column:
    """ISO-8601 text as ``yyyy-MM-dd HH:mm:ss`` in UTC; null where it is no date."""
    from surveyloom.sources.exports import utc_timestamp

    return F.date_format(utc_timestamp(raw), "yyyy-MM-dd HH:mm:ss")


def free_text_questions(questions: DataFrame, skip_other: bool = False) -> DataFrame:
    """FreeText questions; ``skip_other`` leaves out columns with ``TEXT_`` in the id."""
    kept = questions.filter(F.col("data_type") == "FreeText")
    return kept.filter(~F.col("column_id").contains("TEXT_")) if skip_other else kept


def free_text_view(
    responses: DataFrame, questions: DataFrame, skip_other: bool = False
) -> DataFrame:
    """Free-text answers under the text of their question, in long form."""
    asked = free_text_questions(questions, skip_other).dropDuplicates(["survey_id", "column_id"])
    listed = asked.groupBy("survey_id").agg(
        F.map_from_entries(F.collect_list(F.struct("column_id", "question_text"))).alias("_texts")
    )
    joined = with_survey_dimension(responses.select("survey_id", "response_id", "answers"), listed)
    # Other answers are left behind before there is a row for each.
    free = F.filter("answers", lambda a: F.map_contains_key("_texts", a["column_id"]))
    return joined.select("survey_id", "response_id", "_texts", F.explode(free).alias("a")).select(
        "survey_id", "response_id", F.col("a.column_id").alias("column_id"), answer_text(F.col("a")).alias("text"),
        F.try_element_at("_texts", F.col("a.column_id")).alias("question_text"),
    )


def reportable_questions(questions: DataFrame, by_type: bool = False) -> DataFrame:
    """Questions with a frequency table, in report order.

    ``by_type`` puts every MultipleChoice question before the Numeric ones.
    """
    kept = questions.filter(F.col("data_type").isin(*REPORTABLE))
    order = ["survey_id", "flow_pos", "column_id"]
    return kept.orderBy("survey_id", "data_type", *order[1:]) if by_type else kept.orderBy(*order)

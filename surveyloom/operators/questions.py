"""Question and choice dimensions from definitions and answer columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import columns as C

SLIDER_MAX = 5

# Question types with a data type of their own.
TYPE_TO_DATA_TYPE = {
    "FileUpload": "FileUpload",
    "PGR": "Group",
    "Meta": "MetaData",
    "Draw": "Draw",
    "Timing": "Timing",
    "SBS": "Dates",
}


def survey_columns(responses: DataFrame) -> DataFrame:
    """Distinct answer columns per survey, with all-null columns absent."""
    return responses.select(
        "survey_id", F.explode(F.col("answers")["column_id"]).alias("column_id")
    ).distinct()


def is_numeric(question: Column) -> Column:
    """Rank order and slider always; others when numbers are validated."""
    return (
        F.coalesce(question["questionType"]["type"].isin("RO", "Slider"), F.lit(False))
        | question["validation"]["type"].eqNullSafe(F.lit("ValidNumber"))
    )


def choice_label(choice: Column) -> Column:
    """Description of the image if there is one, else the text."""
    return F.coalesce(F.nullif(choice["imageDescription"], F.lit("")), choice["choiceText"])


def question_columns(columns: DataFrame, definitions: DataFrame) -> DataFrame:
    """Answer columns with the definition of their question; others are dropped."""
    parsed = columns.filter(C.is_question_column(F.col("column_id"))).select(
        "survey_id", "column_id", C.parse_column_id(F.col("column_id")).alias("p")
    )
    return parsed.select("survey_id", "column_id", "p.*").join(
        definitions, ["survey_id", "base_qid"]
    )


def _q() -> tuple[Column, Column]:
    question = F.col("question")
    return question, question["questionType"]["type"]


def _ranked_key() -> Column:
    """Choice key at the position a rank-order column stands for."""
    return F.get("choice_order", F.col("sub_no") - 1)


def question_text() -> Column:
    """Text of a column: that of the question, followed by its own part if it has one."""
    question, kind = _q()
    main, sub, last = question["questionText"], F.col("sub_key"), F.col("suffix")

    def tail(separator: str, text: Column) -> Column:
        return F.concat(main, F.lit(separator), text)

    ranked = F.try_element_at(question["choices"], _ranked_key())
    return (
        F.when(kind == "Matrix", tail("| ", F.try_element_at(question["subQuestions"], sub)["choiceText"]))
        .when(kind == "CS", tail("| ", F.try_element_at(question["choices"], sub)["choiceText"]))
        .when((kind == "RO") & (last != "TEXT"), tail(" | ", choice_label(ranked)))
        .when(
            (kind == "Slider") & (last != "TEXT"),
            tail(
                " | ",
                F.coalesce(F.try_element_at(question["choices"], sub)["choiceText"], F.lit("")),
            ),
        )
        .when(
            (kind == "PGR") & (last == "GROUP"),
            tail("| ", F.try_element_at(question["groups"], sub)["description"]),
        )
        .otherwise(main)
    )


def question_dictionary(columns: DataFrame, definitions: DataFrame) -> DataFrame:
    """One row per answer column with name, text, type, selector and the numeric flag.

    ``definitions`` carries ``choice_order`` for rank-order questions.
    """
    question, kind = _q()
    other_text = (kind == "MC") & (F.col("suffix") == "TEXT")
    numeric = (
        is_numeric(question)
        | F.coalesce(kind.isin("CS", "Timing"), F.lit(False))
        | F.coalesce((kind == "SS") & (question["questionType"]["selector"] == "TA"), F.lit(False))
    )
    return question_columns(columns, definitions).select(
        "survey_id",
        "column_id",
        "base_qid",
        "loop_no",
        "question_no",
        "sub_no",
        "suffix",
        question["questionName"].alias("question_name"),
        question_text().alias("question_text"),
        F.when(other_text, "TE").otherwise(kind).alias("question_type"),
        F.when(other_text, "TE").otherwise(question["questionType"]["selector"]).alias("question_selector"),
        numeric.alias("is_numeric"),
    )


def _listed(choices: Column) -> Column:
    """Choices of a definition as (answer_id, question_value)."""
    return F.transform(
        F.map_entries(choices),
        lambda e: F.struct(
            e["value"]["recode"].alias("answer_id"), choice_label(e["value"]).alias("question_value")
        ),
    )


def _numbered(last: Column) -> Column:
    """1..last as (answer_id, question_value); nothing when there is no last."""
    return F.when(
        last >= 1,
        F.transform(
            F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
            lambda i: F.struct(
                i.cast("string").alias("answer_id"), i.cast("string").alias("question_value")
            ),
        ),
    )


def choice_table(
    columns: DataFrame, definitions: DataFrame, slider_max: int = SLIDER_MAX
) -> DataFrame:
    """``(survey_id, column_id, answer_id, question_value, choice_pos)``, unique per answer id.

    The service does not export how far a slider goes; ``slider_max`` says it.
    """
    question, kind = _q()
    plain = F.col("suffix") == ""
    values = (
        F.when(kind.isin("MC", "Matrix") & plain, _listed(question["choices"]))
        .when((kind == "RO") & plain, _numbered(F.size("choice_order")))
        .when((kind == "Slider") & plain, _numbered(F.lit(slider_max)))
    )
    rows = question_columns(columns, definitions).select(
        "survey_id", "column_id", F.posexplode(values).alias("choice_pos", "choice")
    )
    return (
        rows.groupBy("survey_id", "column_id", F.col("choice.answer_id").alias("answer_id"))
        .agg(
            F.min_by("choice.question_value", "choice_pos").alias("question_value"),
            F.min("choice_pos").alias("choice_pos"),
        )
        .select("survey_id", "column_id", "answer_id", "question_value", "choice_pos")
    )


def group_items(columns: DataFrame, definitions: DataFrame) -> DataFrame:
    """Items of pick-group-rank questions per group column."""
    question, kind = _q()
    return (
        question_columns(columns, definitions)
        .filter((kind == "PGR") & (F.col("suffix") == "GROUP"))
        .select("survey_id", "column_id", "base_qid", F.explode(question["items"]).alias("item_id", "item"))
        .select("survey_id", "column_id", "base_qid", "item_id", F.col("item.description").alias("item_text"))
    )


def classify_data_type(dictionary: DataFrame, choices: DataFrame) -> DataFrame:
    """Add ``data_type``; the first rule that fits wins."""
    chosen = choices.select("survey_id", "column_id").distinct().withColumn("_has", F.lit(True))
    kind = F.col("question_type")
    rules = (
        F.when((kind == "RO") | F.col("is_numeric"), "Numeric")
        .when(F.col("_has"), "MultipleChoice")
        .when((kind == "TE") & ~F.col("is_numeric"), "FreeText")
    )
    for question_type, data_type in TYPE_TO_DATA_TYPE.items():
        rules = rules.when(kind == question_type, data_type)
    rules = rules.when((kind == "Matrix") & (F.col("question_selector") == "Likert"), "MultipleChoice")
    return (
        dictionary.join(chosen, ["survey_id", "column_id"], "left")
        .withColumn("data_type", rules.otherwise("Unknown"))
        .drop("_has")
    )


def question_tables(
    columns: DataFrame, definitions: DataFrame, slider_max: int = SLIDER_MAX
) -> tuple[DataFrame, DataFrame]:
    """Question dimension with data types, and choice dimension."""
    choices = choice_table(columns, definitions, slider_max)
    return classify_data_type(question_dictionary(columns, definitions), choices), choices


def _sortable(number: Column) -> Column:
    return F.when(F.length(number) > 6, F.concat(F.lit(":"), F.lpad(number, 19, "0"))).otherwise(
        F.lpad(number, 6, "0")
    )


def order_by_block(questions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Questions in block order; a block entry without columns stays, with nulls.

    ``flow_pos`` is a sortable text of block, element and column position, so
    no survey has to be numbered in one place. Numbers take six digits; longer
    ones take nineteen after a colon, which sorts behind all digits.
    """
    placed = blocks.join(questions, ["survey_id", "base_qid"], "left")
    parts = [
        _sortable(F.coalesce(F.col(c), F.lit(0)).cast("string"))
        for c in ("block_pos", "element_pos", "sub_no", "loop_no")
    ]
    return placed.withColumn("flow_pos", F.concat_ws(".", *parts))


def drop_incomplete_questions(ordered: DataFrame) -> DataFrame:
    """Without rows in which anything is missing."""
    return ordered.na.drop("any")


def survey_id_by_name(surveys: DataFrame, name: str | Column) -> DataFrame:
    """One row: the id if exactly one survey has the name, and a status.

    ``status`` is ``ok``, ``missing`` or ``ambiguous``.
    """
    found = surveys.filter(F.col("name") == name).agg(
        F.count("*").alias("n"), F.min("id").alias("first_id")
    )
    return found.select(
        F.when(F.col("n") == 1, F.col("first_id")).alias("survey_id"),
        F.when(F.col("n") == 1, "ok").when(F.col("n") == 0, "missing").otherwise("ambiguous").alias("status"),
    )


def survey_ids_by_name(surveys: DataFrame, names: DataFrame) -> DataFrame:
    """``survey_id_by_name`` for a table of names: ``(name, survey_id, status)``."""
    counted = surveys.groupBy("name").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    n = F.coalesce("n", F.lit(0))
    return names.select("name").join(counted, "name", "left").select(
        "name",
        F.when(n == 1, F.col("first_id")).alias("survey_id"),
        F.when(n == 1, "ok").when(n == 0, "missing").otherwise("ambiguous").alias("status"),
    )

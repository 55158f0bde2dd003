"""Survey definitions: one JSON document per survey -> rows per question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.json import STRICT
from surveyloom.functions.text import strip_html
from surveyloom.sources.rejects import parsed_documents, rejected_documents

CHOICE = "struct<recode:string,choiceText:string,imageDescription:string>"
QUESTION = (
    "struct<questionName:string,questionText:string,"
    "questionType:struct<type:string,selector:string>,"
    "validation:struct<type:string>,"
    f"choices:map<string,{CHOICE}>,"
    "subQuestions:map<string,struct<choiceText:string>>,"
    "groups:map<string,struct<description:string>>,"
    "items:map<string,struct<description:string>>>"
)
BLOCK = "struct<description:string,elements:array<struct<type:string,questionId:string>>>"
DEFINITION = (
    f"struct<result:struct<questions:map<string,{QUESTION}>,"
    f"blocks:map<string,{BLOCK}>,flow:string>>"
)
FULL_DEFINITION = (
    "struct<result:struct<Questions:map<string,struct<ChoiceOrder:array<string>>>>>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A folder of definition files named ``<survey_id>.json``."""
    name = F.regexp_extract("_metadata.file_path", r"([^/]+?)(\.json)?$", 1)
    return spark.read.text(path, wholetext=True).select(
        name.alias("survey_id"), F.col("value").alias("document")
    )


def parse_definitions(documents: DataFrame, mode: str = STRICT) -> DataFrame:
    """``(survey_id, document)`` -> ``(survey_id, questions, blocks, flow)``, parsed once.

    A broken document ends the job; with ``mode="PERMISSIVE"`` it is passed over.
    """
    return parsed_documents(documents.select("survey_id", "document"), "document", DEFINITION, mode).select(
        "survey_id", "document.result.*"
    )


def rejected_definitions(documents: DataFrame) -> DataFrame:
    """The documents that are no definitions: ``(survey_id, problem, record)``."""
    return rejected_documents(documents.select("survey_id", "document"), "document", DEFINITION)


def read_definitions(documents: DataFrame, mode: str = STRICT) -> DataFrame:
    """One row per question: ``(survey_id, base_qid, question)``.

    Tags are taken out of the question text and of the choices; the text is
    trimmed as well.
    """
    rows = parse_definitions(documents, mode).select(
        "survey_id", F.explode("questions").alias("base_qid", "raw")
    )
    raw = F.col("raw")
    choices = F.transform_values(
        raw["choices"],
        lambda _, c: F.struct(
            strip_html(c["recode"]).alias("recode"),
            strip_html(c["choiceText"]).alias("choiceText"),
            strip_html(c["imageDescription"]).alias("imageDescription"),
        ),
    )
    text = F.regexp_replace(strip_html(raw["questionText"]), r"(?U)^\s+|\s+$", "")
    return rows.select(
        "survey_id",
        "base_qid",
        raw.withField("questionText", text).withField("choices", choices).alias("question"),
    )


def choice_orders(full_documents: DataFrame, mode: str = STRICT) -> DataFrame:
    """``(survey_id, base_qid, choice_order)`` from the full definition documents."""
    read = parsed_documents(full_documents.select("survey_id", "document"), "document", FULL_DEFINITION, mode)
    parsed = read.select("survey_id", F.explode("document.result.Questions").alias("base_qid", "q"))
    return parsed.select("survey_id", "base_qid", F.col("q.ChoiceOrder").alias("choice_order"))


def full_definition_join(definitions: DataFrame, full_documents: DataFrame) -> DataFrame:
    """Definitions with the choice order, each document read once."""
    return definitions.join(choice_orders(full_documents), ["survey_id", "base_qid"], "left")

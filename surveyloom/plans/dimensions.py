"""Question and choice dimensions of all surveys from landed definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from surveyloom.operators import blocks as B
from surveyloom.operators import questions as Q
from surveyloom.sources import definitions as D


@dataclass(frozen=True)
class Dimensions:
    """``questions`` has one row per answer column, ``choices`` one per offered answer."""

    questions: DataFrame
    choices: DataFrame


def survey_dimensions(
    responses: DataFrame,
    documents: DataFrame,
    full_documents: DataFrame,
    slider_max: int = Q.SLIDER_MAX,
    in_flow_only: bool = True,
) -> Dimensions:
    """Dimensions for the columns the responses have.

    ``in_flow_only`` keeps the questions the survey's flow shows, in its order,
    without incomplete ones; otherwise every known column is kept.
    """
    columns = Q.survey_columns(responses)
    definitions = D.full_definition_join(D.read_definitions(documents), full_documents)
    questions, choices = Q.question_tables(columns, definitions, slider_max)
    if not in_flow_only:
        return Dimensions(questions, choices)
    placed = B.blocks(D.parse_definitions(documents))
    return Dimensions(Q.drop_incomplete_questions(Q.order_by_block(questions, placed)), choices)

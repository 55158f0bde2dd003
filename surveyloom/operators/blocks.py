"""Blocks of a survey and the order its flow shows them in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNNAMED_BLOCK = "No Description"
ITEMS = "array<string>"


def block_questions(parsed: DataFrame) -> DataFrame:
    """Questions of every block: ``(survey_id, block_id, block_name, base_qid, element_pos)``."""
    blocks = parsed.select("survey_id", F.explode("blocks").alias("block_id", "block"))
    questions = F.filter("block.elements", lambda e: e["type"] == "Question")
    return blocks.select(
        "survey_id",
        "block_id",
        F.coalesce("block.description", F.lit(UNNAMED_BLOCK)).alias("block_name"),
        F.posexplode(questions).alias("element_pos", "element"),
    ).select("survey_id", "block_id", "block_name", F.col("element.questionId").alias("base_qid"), "element_pos")


def flow_items(flow: Column) -> Column:
    """Flow items in the order shown, with every ``Branch`` replaced by what it holds.

    Items of other types keep what is under them to themselves. Each step opens
    one level in place; there cannot be more levels than mentions of a branch.
    """
    top = F.from_json(flow, ITEMS)

    def open_branches(items: Column, _: Column) -> Column:
        def replace(item: Column) -> Column:
            inner = F.from_json(F.get_json_object(item, "$.flow"), ITEMS)
            is_branch = F.get_json_object(item, "$.type") == "Branch"
            return F.when(is_branch, F.coalesce(inner, F.array().cast(ITEMS))).otherwise(F.array(item))

        return F.flatten(F.transform(items, replace))

    mentions = F.size(F.split(flow, '"Branch"')) - 1
    return F.when(mentions < 1, top).otherwise(
        F.reduce(F.sequence(F.lit(1), F.greatest(mentions, F.lit(1))), top, open_branches)
    )


def flow_order(parsed: DataFrame) -> DataFrame:
    """``(survey_id, block_pos, block_id)`` in the order the flow shows the blocks."""
    shown = F.filter(
        flow_items(F.col("flow")), lambda i: F.get_json_object(i, "$.type") == "Block"
    )
    return parsed.select("survey_id", F.posexplode(shown).alias("block_pos", "item")).select(
        "survey_id", "block_pos", F.get_json_object("item", "$.id").alias("block_id")
    )


def blocks(parsed: DataFrame) -> DataFrame:
    """``(survey_id, block_pos, element_pos, block_name, base_qid)``.

    A block shown twice lists its questions twice.
    """
    return (
        flow_order(parsed)
        .join(block_questions(parsed), ["survey_id", "block_id"])
        .select("survey_id", "block_pos", "element_pos", "block_name", "base_qid")
    )

"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import decontamination, toxicity
from surveyloom.llm.common import fold
from surveyloom.llm.near_dedup import near_duplicates
from surveyloom.llm.packing import pack
from surveyloom.session import store


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents predicted toxic by a model of the labels whose fold of four is not 2."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels.where(fold("doc_id", 4) != 2)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id.

    Of several rows with that id, and in a group without any id, the first row
    stays. ``docs`` has to be a stored table, whose rows keep their places.
    """
    place = "_place"
    while place in docs.columns:
        place += "_"
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    # A row's id for the operator: rows without a doc_id come last, repeated ones by their place.
    row = F.struct(F.isnull("doc_id").alias("missing"), "doc_id", F.col(place).alias("place"))
    groups = near_duplicates(placed.select(row.alias("row"), "text"), "row", length=3, radius=2)
    kept = groups.where("row = component_id").select(F.col("row.place").alias(place))
    # Only the narrow side is hashed, so texts are moved once and not sorted.
    return placed.join(kept.hint("shuffle_hash"), place, "left_semi").drop(place)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the documents stands in sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=4096, end=2)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_of_toxicity),
    ("near_duplicates", one_of_each_group),
    ("decontamination", clean_of_benchmarks),
    ("packing", packed),
]
# Scores learnt from labels and fingerprints are beyond SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

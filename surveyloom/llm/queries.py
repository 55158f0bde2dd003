"""The text operators over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import decontamination, html_text, language_model, licenses, lookup_clusters, merkle, oracle, prefix_table, sharding, toxicity
from surveyloom.llm.common import fold
from surveyloom.llm.near_dedup import near_duplicates
from surveyloom.llm.neighbours import nearest
from surveyloom.llm.packing import pack
from surveyloom.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# The operators that SQL over the tables can express; tests/llm compares each of the others with a plain version.
ORACLE: dict[str, str] = {"op11_centroid_clusters": oracle.clusters(), "op13_merkle_manifest": oracle.manifest()}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), length=3, radius=2)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels.where(fold("doc_id", 4) != 2))
    return toxicity.score(documents, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "passages"
    )


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=4096, end=2)


@query
def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op4_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = language_model.score(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)
    return scored.select(
        "doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    clustered, centroids = lookup_clusters.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, start=start)
    spelled = spark.createDataFrame(
        [(i, ",".join(map(str, c))) for i, c in enumerate(centroids)], "cluster int, components string"
    )
    named = spelled.select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    return clustered.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


@query
def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = prefix_table.encode(table(spark, sf_dir, "documents"), model, decoded=True)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(chosen, lower).otherwise(F.col("text"))
    return merkle.manifest(
        documents.select(
            "doc_id", "lang", merkle.digest(columns).alias("leaf"),
            merkle.digest([*columns[:-1], tampered]).alias("now"),
        ),
        group="lang", key="doc_id", now="now",
    ).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")

"""The operators of this package as named queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwell.llm import (
    clustering,
    divergence,
    exact,
    language,
    lines,
    mixing,
    neighbours,
    packing,
    passages,
    secrets,
    sharding,
    simhash,
    sketches,
)
from meterwell.llm.tables import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(documents(spark, sf_dir))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(documents(spark, sf_dir), sharding.shard_names())
    return placed.select("doc_id", "source", "shard")


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", digest, "spans", "n_live", "n_copied"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_QUERIES = (
    op1_embedding_near_dedup,
    op2_best_fit_packing,
    op3_document_fingerprints,
    op4_source_mixing,
    op5_sharding,
    op6_passage_dedup,
    op7_line_dedup,
    op8_simhash_near_dedup,
    op9_secret_scan,
    op10_language_id,
    op11_source_divergence,
    op12_exact_dedup,
    op13_centroid_clustering,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express."""
    return {
        op4_source_mixing.__name__: mixing.SQL,
        op6_passage_dedup.__name__: passages.SQL,
        op7_line_dedup.__name__: lines.SQL,
        op9_secret_scan.__name__: secrets.SQL,
        op11_source_divergence.__name__: divergence.SQL,
        op12_exact_dedup.__name__: exact.SQL,
        op13_centroid_clustering.__name__: clustering.SQL,
    }

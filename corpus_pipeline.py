"""The corpus pipeline: stages over `documents`, each written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwell.llm import language, lines, mixing, packing, simhash
from meterwell.llm.tables import documents, stored


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages the corpus names; the rest goes."""
    return language.in_some_language(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents repeat, and their new lengths."""
    kept = lines.without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def weighted_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences for training."""
    return packing.pack(docs)


STAGES = [
    ("language id", known_languages),
    ("line dedup", distinct_lines),
    ("simhash near-dedup", one_of_each),
    ("source mixing", weighted_sources),
    ("best-fit packing", sequences),
]

# Code lengths, fingerprints and tokens are not SQL; tests hold the stages against
# plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""Corpus preparation over ``documents``: toxic documents go, one document of each near-duplicate class stays,
documents with benchmark passages go, and the rest is encoded.

Null and empty texts are no toxic, no duplicate and no benchmark text, so they stay and have no ids. Null and
repeated doc_ids are kept apart by their texts. Repeated rows are one class. Extra columns pass the filters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roomtide.llm import bpe, decontamination, jaccard, toxicity
from roomtide.llm.queries import table, vocabulary
from roomtide.llm.support import scratch


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels of the documents it is given."""
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, weights)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that share 80 % of their five-word shingles."""
    return jaccard.one_of_each_class(docs, width=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' token counts and digests."""
    return bpe.round_trip_digests(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Training and set similarity are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None

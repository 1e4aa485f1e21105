"""The registered queries of this package and their SQL."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm import (
    bpe, decontamination, extraction, fingerprints, huffman, jaccard, language_model, preferences, prefix_trie, quality, repair, sharding, toxicity,
)


def vocabulary(name: str) -> str:
    """A vocabulary file: in the folder ROOMTIDE_TOKENIZERS names, else where ``public_tokenizers`` has it."""
    folder = os.environ.get("ROOMTIDE_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    found = importlib.util.find_spec("public_tokenizers")
    return f"{os.path.dirname(found.origin) if found else '/opt/tokenizers'}/{name}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.reply_pairs(table(spark, sf_dir, "conversations"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_classes(table(spark, sf_dir, "documents"), width=4, percent=85)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op9_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end=0)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_corpus(table(spark, sf_dir, "documents"))


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_opening_trie(table(spark, sf_dir, "conversations"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_sharding": op2_sharding,
        "op3_decontamination": op3_decontamination,
        "op4_preferences": op4_preferences,
        "op5_fingerprints": op5_fingerprints,
        "op6_toxicity": op6_toxicity,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_main_text": op8_main_text,
        "op9_huffman_files": op9_huffman_files,
        "op10_language_model": op10_language_model,
        "op11_line_quality": op11_line_quality,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_repair": op13_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_preferences": preferences.REPLY_SQL,
        "op12_prefix_trie": prefix_trie.ORACLE_SQL,
        "op13_repair": repair.ORACLE_SQL,
    }

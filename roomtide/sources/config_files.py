"""Capture configuration files: which creators to begin with, by category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.operators.registry import as_registry_events

SCHEMA = "categories map<string,struct<streamers:array<string>>>"
ROOM = 1 << 20  # sequence numbers for the creators of one category of one document


def read_config(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(place, category, handle) of every configured creator, in the order of the file.

    A file is one JSON document, or has one on each line with ``multi_line=False``. Categories without creators give
    no row, and neither do documents that cannot be read.
    """
    documents = spark.read.option("multiLine", multi_line).schema(SCHEMA).json(path)
    listed = documents.select(F.posexplode("categories").alias("at", "category", "settings"))
    each = listed.select("at", "category", F.posexplode("settings.streamers").alias("place", "handle"))
    return each.select((F.col("at") * ROOM + F.col("place")).cast("long").alias("place"), "category", "handle")


def config_adds(config: DataFrame, first_seq: int = 0) -> DataFrame:
    """Configured creators as ``add`` events; their archetype is general."""
    return as_registry_events(
        config.withColumns(
            {
                "seq": F.col("place") + first_seq, "op": F.lit("add"), "archetype": F.lit("general"),
                "source": F.lit("config_seed"), "ts": F.current_timestamp(),
            }
        )
    )

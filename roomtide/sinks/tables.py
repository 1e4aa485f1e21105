"""Typed tables on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roomtide.schemas import LIVE_SORT
from roomtide.functions.timeparts import yyyymm
from pyspark.sql import functions as F

ROWS_PER_FILE = 5_000_000


def materialise(tables: dict[str, DataFrame], database: str | None = None, prefix: str = "silver_") -> list[str]:
    """Replace one catalog table per entry."""
    names = []
    for name, df in tables.items():
        target = f"{database}.{prefix}{name}" if database else f"{prefix}{name}"
        df.write.mode("overwrite").format("parquet").saveAsTable(target)
        names.append(target)
    return names


def export(tables: dict[str, DataFrame], folder: str, prefix: str = "silver_") -> list[str]:
    """Replace one Parquet folder per entry."""
    paths = []
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{prefix}{name}"
        df.write.mode("overwrite").parquet(path)
        paths.append(path)
    return paths


def write_day(df: DataFrame, path: str) -> None:
    """One day of a typed table by category and streamer, ZSTD; running it again replaces the day.

    The rebalance puts a streamer's rows together, so small streamers get one file; it splits a
    streamer that fills more than a partition, so a hot one is not one task's work.
    """
    (
        df.hint("rebalance", F.col("category"), F.col("streamer"))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("category", "streamer")
        .parquet(path)
    )


def write_live(df: DataFrame, table: str, root: str, batch_id: int) -> None:
    """One micro-batch into a live table: month folders, sorted inside, replaced if replayed.

    The rebalance gives a month one file, or as many as its size asks for, instead of one from every task.
    """
    key = LIVE_SORT[table]
    (
        df.withColumns({"yyyymm": yyyymm(F.col("event_timestamp")), "batch_id": F.lit(batch_id)})
        .hint("rebalance", F.col("yyyymm"))
        .sortWithinPartitions("yyyymm", *key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("yyyymm", "batch_id")
        .parquet(f"{root.rstrip('/')}/{table}")
    )

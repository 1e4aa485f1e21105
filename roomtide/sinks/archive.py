"""The raw archive writer, for batches and micro-batches alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.functions.identity import filled
from roomtide.sources.archive import PARTITIONS, archive_columns, one_line

ROWS_PER_FILE = 1_000_000
RECEIVED_AT = r'"received_at"\s*:\s*"([^"]*)"'


def write_archive(messages: DataFrame, root: str, batch_id: int, rows_per_file: int = ROWS_PER_FILE,
                  rebalance: bool = False) -> None:
    """Write (topic, value) rows, one line each, under topic and hour of receipt (UTC).

    Each batch has its own folder below the hour, which a replay replaces. A damaged message is filed
    under the time that can be found in its text; without one it lands in the null partition of the
    hour columns and is not lost.

    A micro-batch spans an hour or two, so its tasks write as they are, without a shuffle. Set
    ``rebalance`` for a backfill of many hours, where each task would write a file for every hour.
    """
    found = filled(F.regexp_extract("value", RECEIVED_AT, 1))
    received = F.coalesce(F.get_json_object("value", "$.received_at"), found)
    parts = archive_columns(F.col("topic"), received)
    placed = messages.withColumns({**parts, "batch": F.lit(batch_id)}).select(
        one_line(F.col("value")).alias("value"), *PARTITIONS, "batch"
    )
    if rebalance:
        placed = placed.hint("rebalance", *[F.col(p) for p in PARTITIONS])
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITIONS, "batch")
        .text(root)
    )

"""Windowed counts of a live stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomtide.operators.telemetry import EVERY, plausible, timed_events, window_counts
from roomtide.schemas import TABLES


def count_batch(envelope: DataFrame, batch_id: int, root: str, every: str = EVERY) -> None:
    """The windows that a micro-batch touches, in a folder of the batch that a replay replaces."""
    counts = window_counts(plausible(timed_events(envelope)), every)
    (
        counts.select(F.col("window.start").alias("window_start"), "events", *TABLES, F.lit(batch_id).alias("batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(root)
    )


def start_heartbeat(envelope: DataFrame, root: str, checkpoint: str, every: str = EVERY,
                    trigger: str | None = None) -> StreamingQuery:
    """Count a stream of envelopes. Each batch stores its own counts and no state is kept, so no event is
    too late and a clock in the future shuts nobody out. Implausible clocks are left out as over the whole."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        count_batch(batch, batch_id, root, every)

    writer = envelope.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def read_heartbeat(spark: SparkSession, root: str) -> DataFrame:
    """All windows so far: the batches' counts, summed."""
    kinds = ", ".join(f"{kind} bigint" for kind in TABLES)
    stored = spark.read.schema(f"window_start timestamp, events bigint, {kinds}, batch_id bigint").parquet(root)
    return stored.groupBy("window_start").agg(*[F.sum(c).alias(c) for c in ("events", *TABLES)])

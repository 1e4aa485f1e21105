"""Session totals and running like totals over micro-batches, by states that merge whatever the batches' borders.

Each batch stores, in a folder of its own, what its events tell of a streamer and month: sums, bounds, and the last
readings with their times. Of two states the sums add, the bounds widen and the later reading stays, so late events and
any split into batches give the same. A second state holds the last known like total of each streamer and five
minutes, so that a stretch of time can be read without what came before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomtide.functions.timeparts import yyyymm
from roomtide.operators.sessions import (
    LAST_READINGS, LIKE_BUCKET, activity, carry_like_total, like_closings, session_sums, with_rates,
)
from roomtide.schemas import ENVELOPE
from roomtide.sinks.months import fold_months, read_months

SUMS = ("total_diamonds", "priced", "unpriced", "total_comments")


def _store(rows: DataFrame, path: str, batch_id: int) -> None:
    (
        rows.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", F.col("yyyymm"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("yyyymm", "batch_id").parquet(path)
    )


def session_states(envelope: DataFrame) -> DataFrame:
    events = activity(envelope).where(F.col("ts").isNotNull()).withColumn("yyyymm", yyyymm(F.col("ts")))
    at = {value: F.when(F.col(value).isNotNull(), F.col("ts")) for value in LAST_READINGS.values()}
    readings = [
        column for name, value in LAST_READINGS.items()
        for column in (F.max_by(F.col(value), at[value]).alias(name), F.max(at[value]).alias(f"{name}_at"))
    ]
    return events.groupBy("yyyymm", "streamer").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), *session_sums(), *readings
    )


def merge_sessions(states: DataFrame, months: bool = True) -> DataFrame:
    readings = [
        column for name in LAST_READINGS
        for column in (F.max_by(name, f"{name}_at").alias(name), F.max(f"{name}_at").alias(f"{name}_at"))
    ]
    return states.groupBy(*(["yyyymm"] if months else []), "streamer").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *[F.sum(c).alias(c) for c in SUMS], *readings,
    )


def _sessions_path(root: str) -> str:
    return f"{root.rstrip('/')}/states/sessions"


def _session_columns(spark: SparkSession):
    return session_states(spark.createDataFrame([], ENVELOPE)).schema


def write_sessions(envelope: DataFrame, root: str, batch_id: int) -> None:
    """Add a micro-batch to the session totals; a replay replaces it."""
    _store(session_states(envelope), _sessions_path(root), batch_id)


def start_sessions(envelope: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the session totals of a stream of envelopes."""
    writer = envelope.writeStream.foreachBatch(lambda batch, number: write_sessions(batch, root, number))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_sessions(spark: SparkSession, root: str) -> DataFrame:
    """The summary of every streamer over all batches, as ``session_summary`` gives it over all events."""
    states = merge_sessions(read_months(spark, _sessions_path(root), _session_columns(spark)), months=False)
    found = states.withColumns({name: F.coalesce(name, F.lit(0)) for name in LAST_READINGS})
    return with_rates(found.drop(*[f"{name}_at" for name in LAST_READINGS]))


def compact_sessions(spark: SparkSession, root: str, upto: int) -> list[str]:
    """Merge the states of all batches up to ``upto``, a finished one; gives the months that changed."""
    return fold_months(spark, _sessions_path(root), _session_columns(spark), upto, merge_sessions)


def _closings_path(root: str) -> str:
    return f"{root.rstrip('/')}/states/like_closings"


def _closings(likes: DataFrame, tie_break: tuple[str, ...]) -> DataFrame:
    month = yyyymm(F.timestamp_seconds(F.col("bucket") * LIKE_BUCKET))
    return like_closings(likes, LIKE_BUCKET, tie_break).where(F.col("bucket").isNotNull()).withColumn("yyyymm", month)


def write_likes(likes: DataFrame, root: str, batch_id: int, tie_break: tuple[str, ...] = ()) -> None:
    """Add the like totals of a micro-batch (event_timestamp, streamer, total_room_likes) to the closings."""
    _store(_closings(likes, tie_break), _closings_path(root), batch_id)


def merge_closings(closings: DataFrame) -> DataFrame:
    return closings.groupBy("yyyymm", "streamer", "bucket").agg(
        F.max_by("closing", "closing_at").alias("closing"), F.max("closing_at").alias("closing_at")
    )


def compact_likes(likes: DataFrame, root: str, upto: int, tie_break: tuple[str, ...] = ()) -> list[str]:
    """Merge the closings of all batches up to ``upto``; ``likes`` only tells the columns."""
    columns = _closings(likes.limit(0), tie_break).schema
    return fold_months(likes.sparkSession, _closings_path(root), columns, upto, merge_closings)


def carried_likes(likes: DataFrame, root: str, first_bucket: int, end_bucket: int, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """``likes`` of the five-minute buckets from ``first_bucket`` to before ``end_bucket``, absent totals filled.

    ``likes`` has all rows of these buckets; what came before is read from the closings.
    """
    spark = likes.sparkSession
    columns = _closings(likes.limit(0), tie_break).schema
    stored = merge_closings(read_months(spark, _closings_path(root), columns).where(F.col("bucket") < first_bucket))
    opening = stored.groupBy("streamer").agg(
        F.max_by("closing", "closing_at").alias("closing"), F.max(F.when(F.col("closing").isNotNull(), F.col("bucket"))).alias("bucket")
    ).where(F.col("bucket").isNotNull())
    bucket = F.floor(F.unix_micros("event_timestamp") / F.lit(LIKE_BUCKET * 1_000_000))
    return carry_like_total(likes.where(bucket.between(first_bucket, end_bucket - 1)), LIKE_BUCKET, tie_break, opening)

"""The qualification gate on a running stream: verdicts ``seconds`` after a session's start, while it goes on.

The capture's stream of envelopes carries two control types beside the events: ``session_start``, and ``session_end``,
whose payload names the start. Starts and events meet in a stream-stream join on the streamer and a bucket of time as
long as the probation, so that an event meets only starts near it in time; the join is bounded in time on both sides: an
event waits for starts up to the probation's length back, a start for events until its probation is over, and
the watermark lets both go. What has met is added up per session in each micro-batch and written to a folder of the
batch, which a replay replaces; these sums merge. A verdict is given once the watermark has passed the end of the
probation, so no later event can change it: events older than the watermark are dropped by the join, and
``late_events`` counts them.

``salts`` spreads a streamer's events of a bucket over that many tasks, each with a copy of the streamer's starts.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomtide.functions.casts import event_time
from roomtide.operators.gate import MEASURES, MIN_VIEWERS, PROBATION_SECONDS, judge, merged_metrics, metrics
from roomtide.operators.joins import time_bucket
from roomtide.operators.sessions import activity
from roomtide.sinks.folders import child_names, read_text

START, END = "session_start", "session_end"
SESSION = ("streamer", "category", "session_start")
PARTIALS = (
    "streamer string, category string, session_start timestamp, session_end timestamp, started boolean, viewers bigint, "
    "gifts bigint, diamonds bigint, comments bigint, likes bigint, has_shop_products boolean, batch_id bigint"
)


def control_messages(sessions: DataFrame) -> DataFrame:
    """Envelopes that tell the starts of sessions, and the ends of those that have ended."""

    def at(column: str):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")

    def told(kind: str):
        return sessions.where(F.col(kind).isNotNull()).select(
            "streamer", "category", F.lit(None).cast("string").alias("archetype"), F.lit(kind).alias("event_type"),
            at(kind).alias("received_at"), F.to_json(F.struct(at("session_start").alias("session_start"))).alias("data"),
        )

    return told(START).unionByName(told(END))


def watched(envelope: DataFrame, seconds: int = PROBATION_SECONDS, delay: str = "1 minute", salts: int = 1) -> DataFrame:
    """Rows of sessions, each with an event of the probation, with none, or with the session's end.

    A start has a copy for each bucket and salt, so it may give several rows without an event.
    """
    bucket = max(1, int(seconds))
    timed = envelope.withColumn("at", event_time(F.col("received_at"))).where(F.col("at").isNotNull()).withWatermark("at", delay)
    events = activity(timed.where(~F.col("event_type").isin(START, END)), keep=("at",)).select(
        F.col("streamer").alias("_streamer"), F.col("at").alias("ts"), *MEASURES,
        F.pmod(F.xxhash64("at", *MEASURES), F.lit(salts)).alias("_salt"), time_bucket(F.col("at"), bucket).alias("_bucket"),
    )
    first, last = time_bucket(F.col("at"), bucket), time_bucket(F.expr(f"at + interval {int(seconds)} seconds"), bucket)
    starts = timed.where(F.col("event_type") == START).select(
        "streamer", "category", F.col("at").alias("session_start"), F.explode(F.sequence(first, last)).alias("_of_bucket")
    ).withColumn("_of_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = starts.join(
        events,
        (F.col("streamer") == F.col("_streamer")) & (F.col("_of_bucket") == F.col("_bucket")) & (F.col("_of_salt") == F.col("_salt"))
        & (F.col("ts") >= F.col("session_start")) & (F.col("ts") <= F.expr(f"session_start + interval {int(seconds)} seconds")),
        "leftOuter",
    ).select(*SESSION, F.lit(None).cast("timestamp").alias("session_end"), F.lit(True).alias("started"), *MEASURES)
    ends = timed.where(F.col("event_type") == END).select(
        "streamer", "category", event_time(F.get_json_object("data", "$.session_start")).alias("session_start"),
        F.col("at").alias("session_end"), F.lit(False).alias("started"),
        *[F.lit(None).cast(met.schema[m].dataType).alias(m) for m in MEASURES],
    )
    return met.unionByName(ends)


def add_batch(rows: DataFrame, batch_id: int, root: str) -> None:
    """The sums of one micro-batch's rows."""
    sums = rows.groupBy(*SESSION).agg(F.max("session_end").alias("session_end"), F.bool_or("started").alias("started"), *metrics())
    (
        sums.withColumn("batch_id", F.lit(batch_id)).hint("rebalance")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(root)
    )


def start_gate(envelope: DataFrame, root: str, checkpoint: str, seconds: int = PROBATION_SECONDS, delay: str = "1 minute",
               every: str | None = None, salts: int = 1) -> StreamingQuery:
    """Start adding up probations out of a stream of envelopes with control messages."""
    writer = watched(envelope, seconds, delay, salts).writeStream.foreachBatch(lambda rows, batch: add_batch(rows, batch, root))
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def watermark(spark: SparkSession, checkpoint: str) -> datetime:
    """The watermark of the last finished batch, as its checkpoint has it; 1970 before the first."""
    checkpoint = checkpoint.rstrip("/")
    done = sorted(int(n) for n in child_names(spark, f"{checkpoint}/commits") if n.isdigit())
    millis = 0
    if done:
        lines = read_text(spark, f"{checkpoint}/offsets/{done[-1]}").splitlines()
        millis = json.loads(lines[1])["batchWatermarkMs"]
    return datetime.fromtimestamp(millis / 1000, timezone.utc)


def verdicts(spark: SparkSession, root: str, decided: datetime, seconds: int = PROBATION_SECONDS, min_viewers: int = MIN_VIEWERS) -> DataFrame:
    """Metrics and verdict of the sessions whose probation was over at ``decided``, the stream's watermark.

    A session that ended before has no verdict. ``session_end`` is null while a session goes on.
    """
    parts = spark.read.schema(PARTIALS).parquet(root)
    summed = parts.groupBy(*SESSION).agg(F.max("session_end").alias("session_end"), F.bool_or("started").alias("started"), *merged_metrics())
    over = F.col("session_start") + F.make_dt_interval(secs=F.lit(seconds))
    lasting = F.coalesce(F.col("session_end") >= over, F.lit(True))
    measured = summed.where(F.col("started") & (over < F.lit(decided)) & lasting).drop("started")
    return judge(measured, min_viewers)


def late_events(query: StreamingQuery) -> int:
    """Rows that a running or stopped query has dropped because they were older than the watermark."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)

"""Probation metrics and the qualification gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.operators.joins import events_within
from roomtide.operators.sessions import activity

KEY = ("streamer", "category", "session_start", "session_end")
MEASURES = ("event_type", "repeat_count", "coins", "viewers", "taps")

# Fixed values of the gate.
PROBATION_SECONDS = 90
MIN_VIEWERS = 5
MIN_COMMENTS_NPC = 3
MIN_COMMENTS_OTHER = 1


def probation_metrics(envelope: DataFrame, sessions: DataFrame, seconds: int = PROBATION_SECONDS) -> DataFrame:
    """What each session showed in its first ``seconds``; gifts in mid-combo count too.

    Sessions that ended sooner give no row, silent ones give zeros. The zero rows join the aggregation
    as input, which saves an outer join behind it.
    """
    lasting = sessions.withColumn(
        "probation_end", F.col("session_start") + F.make_dt_interval(secs=F.lit(seconds))
    ).where(F.col("session_end") >= F.col("probation_end"))
    events = activity(envelope).select(
        "streamer", "event_type", "ts", "repeat_count", "coins", "viewers", "taps"
    )
    matched = events_within(
        events, lasting, key="streamer", ts="ts",
        start="session_start", end="probation_end", bucket_seconds=max(1, int(seconds)),
    )
    rows = matched.select(*KEY, *MEASURES).unionByName(lasting.select(*KEY), allowMissingColumns=True)
    return rows.groupBy(*KEY).agg(*metrics())


def metrics() -> list[Column]:
    """A session's metrics over its rows; rows without an event add nothing."""

    def total(column: str):
        return F.coalesce(F.sum(column), F.lit(0))

    return [
        F.coalesce(F.max("viewers"), F.lit(0)).alias("viewers"),
        total("repeat_count").alias("gifts"),
        total("coins").alias("diamonds"),
        F.count_if(F.col("event_type") == "comment").alias("comments"),
        total("taps").alias("likes"),
        F.coalesce(F.bool_or(F.col("event_type") == "product_pin"), F.lit(False)).alias("has_shop_products"),
    ]


def merged_metrics() -> list[Column]:
    """The metrics of a session out of those of parts of its rows."""
    totals = [F.sum(c).alias(c) for c in ("gifts", "diamonds", "comments", "likes")]
    return [F.max("viewers").alias("viewers"), *totals, F.bool_or("has_shop_products").alias("has_shop_products")]


def qualify(envelope: DataFrame, sessions: DataFrame, seconds: int = PROBATION_SECONDS,
            min_viewers: int = MIN_VIEWERS, enabled: bool = True) -> DataFrame:
    """Probation metrics with the verdict ``is_qualified``; no rows when the gate is off."""
    judged = judge(probation_metrics(envelope, sessions, seconds), min_viewers)
    return judged if enabled else judged.where(F.lit(False))


def judge(measured: DataFrame, min_viewers: int = MIN_VIEWERS) -> DataFrame:
    """The metrics with the verdict ``is_qualified``."""
    watched = F.col("viewers") >= min_viewers
    active = (F.col("gifts") > 0) | (F.col("diamonds") > 0) | (F.col("comments") >= MIN_COMMENTS_NPC)
    talking = F.col("comments") >= MIN_COMMENTS_OTHER
    verdict = F.when(F.col("category") == "npc", watched & active).otherwise(
        F.col("has_shop_products") | (watched & talking)
    )
    return measured.withColumn("is_qualified", verdict)


def probation_events(verdicts: DataFrame, seconds: int = PROBATION_SECONDS) -> DataFrame:
    """Verdicts as registry events; ``seq`` is the microsecond of the verdict."""
    decided = F.col("session_start") + F.make_dt_interval(secs=F.lit(seconds))
    return verdicts.select(
        F.unix_micros(decided).alias("seq"),
        decided.alias("ts"),
        F.lower("streamer").alias("handle"),
        F.lit("probation").alias("op"),
        F.col("is_qualified").alias("passed"),
        "viewers",
        "diamonds",
    )

"""The periodic heartbeat as running totals over fixed windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.casts import event_time
from roomtide.runtime import cut_lineage
from roomtide.schemas import TABLES

EVERY = "5 minutes"
# The heartbeat's calendar; at five minutes a century is ten million rows, made day by day.
EARLIEST, LATEST = "2000-01-01T00:00:00Z", "2100-01-01T00:00:00Z"
DAY = 86_400_000_000


def window_counts(timed: DataFrame, every: str = EVERY) -> DataFrame:
    """Events per window, in all and per known type; usable on batch and stream."""
    return timed.groupBy(F.window("ts", every)).agg(*_counts())


def _counts() -> list[Column]:
    by_kind = [F.count_if(F.col("event_type") == kind).alias(kind) for kind in TABLES]
    return [F.count(F.lit(1)).alias("events"), *by_kind]


def timed_events(envelope: DataFrame) -> DataFrame:
    timed = envelope.select("streamer", "event_type", event_time(F.col("received_at")).alias("ts"))
    return timed.where(F.col("ts").isNotNull() & F.col("event_type").isin(*TABLES))


def heartbeat(envelope: DataFrame, every: str = EVERY, earliest: str = EARLIEST, latest: str = LATEST) -> DataFrame:
    """One row per window from the first event to the last, quiet windows included.

    Totals run from the first event on, ``eps`` is the total over the time up to the window's end.
    Events before ``earliest`` or from ``latest`` on carry a broken clock and are left out
    (:func:`implausible`): they would stretch the calendar over centuries.

    One scan: events shrink to (window, streamer), then to windows, which are written to the checkpoint folder, since
    three parts of the result need them. Running sums and the quiet windows are made day by day, each day by itself; what
    goes over all days has one row per day.
    """
    micros = F.unix_micros(F.lit("1970-01-01T00:00:00Z").cast("timestamp") + F.expr(f"interval {every}"))
    start = F.unix_micros(F.window("ts", every).getField("start")).alias("at")
    timed = plausible(timed_events(envelope), earliest, latest)
    per_streamer = timed.groupBy(start, "streamer").agg(*_counts(), F.min("ts").alias("first_ts"))
    sums = ("events", *TABLES)
    per_window = per_streamer.groupBy("at").agg(
        F.count("streamer").alias("active"), *[F.sum(c).alias(c) for c in sums], F.min("first_ts").alias("first_ts")
    ).withColumn("day", F.floor(F.col("at") / DAY))
    per_window = cut_lineage(per_window)
    per_day = per_window.groupBy("day").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("first_ts").alias("first_ts"), F.min("at").alias("from"), F.max("at").alias("until")
    )
    ends = per_day.agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min("first_ts").alias("first_ts"),
        F.min("from").alias("from"), F.max("until").alias("until"),
    ).where("first_day is not null")
    days = ends.select(F.explode(F.sequence("first_day", "last_day")).alias("day"), "first_ts", "from", "until")
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.join(per_day.select("day", *sums), "day", "left").select(
        "day", "first_ts", "from", "until", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in sums]
    )
    opening = F.ceil(F.col("day") * DAY / micros) * micros
    beats = days.withColumn("at", F.explode(F.when(opening < (F.col("day") + 1) * DAY, F.sequence(opening, (F.col("day") + 1) * DAY - 1, micros))))
    beats = beats.where(F.col("at").between(F.col("from"), F.col("until"))).join(
        per_window.drop("first_ts"), ["day", "at"], "left"
    )
    so_far = Window.partitionBy("day").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def total(column: str) -> Column:
        return F.col(f"{column}_before") + F.coalesce(F.sum(column).over(so_far), F.lit(0))

    end = F.col("at") + micros
    uptime = (end - F.unix_micros("first_ts")) / F.lit(1_000_000.0)
    return beats.select(
        F.timestamp_micros("at").alias("window_start"),
        F.timestamp_micros(end).alias("window_end"),
        F.coalesce("active", F.lit(0)).alias("active_streamers"),
        total("events").alias("total_events"),
        *[total(kind).alias(f"{kind}_total") for kind in TABLES],
        uptime.alias("uptime_seconds"),
    ).withColumn("eps", F.col("total_events") / F.col("uptime_seconds"))


def _plausible(earliest: str, latest: str) -> Column:
    return (F.col("ts") >= F.lit(earliest).cast("timestamp")) & (F.col("ts") < F.lit(latest).cast("timestamp"))


def plausible(timed: DataFrame, earliest: str = EARLIEST, latest: str = LATEST) -> DataFrame:
    """Events whose clock lies in the heartbeat's calendar; the same for batch and stream."""
    return timed.where(_plausible(earliest, latest))


def implausible(envelope: DataFrame, earliest: str = EARLIEST, latest: str = LATEST) -> DataFrame:
    """Events whose readable time lies outside the heartbeat's calendar."""
    return timed_events(envelope).where(~_plausible(earliest, latest))


def breakdown(beats: DataFrame) -> DataFrame:
    """Heartbeat totals in long form, types without events left out."""
    kinds = ", ".join(f"'{k}', {k}_total" for k in TABLES)
    long = beats.select("window_start", F.expr(f"stack({len(TABLES)}, {kinds}) as (event_type, total)"))
    return long.where(F.col("total") > 0)

"""Live sessions: bounds, totals, leaderboards and the running like total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.casts import event_time, to_bigint, to_double, to_flag
from roomtide.functions.timeparts import seconds_between
from roomtide.operators.gold import in_usd
from roomtide.operators.joins import events_within, time_bucket
from roomtide.operators.silver import text_column, with_payload_text

SESSION = ("streamer", "session_start", "session_end")
HOUR = 3600
LIKE_BUCKET = 300
LAST_READINGS = {"last_viewer_count": "viewers", "total_likes": "room_likes"}  # result <- value


def activity(envelope: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The numbers the session operators need, one parse per event, NULL where they do not apply.

    ``keep`` names further columns of the input that stay, such as one with a watermark.
    """
    keys = [
        "unique_id", "user", "gift_name", "diamond_count", "repeat_count", "streaking", "usd_value",
        "viewer_count", "batch_count", "total_room_likes",
    ]
    parsed = with_payload_text(envelope, keys)

    def only(kind: str, value: Column) -> Column:
        return F.when(F.col("event_type") == kind, value)

    def text(key: str) -> Column:
        return F.col(text_column(key))

    repeat = F.coalesce(to_bigint(text("repeat_count")), F.lit(1))
    diamonds = F.coalesce(to_bigint(text("diamond_count")), F.lit(0))
    return parsed.select(
        *keep,
        "streamer",
        "category",
        "event_type",
        event_time(F.col("received_at")).alias("ts"),
        only("gift", F.coalesce(text("unique_id"), text("user"))).alias("gifter"),
        only("gift", text("gift_name")).alias("gift_name"),
        only("gift", repeat).alias("repeat_count"),
        only("gift", diamonds * repeat).alias("coins"),
        only("gift", ~to_flag(F.coalesce(text("streaking"), F.lit("false")))).alias("is_final"),
        only("gift", to_double(text("usd_value"))).alias("usd_value"),
        only("room_users", F.coalesce(to_bigint(text("viewer_count")), F.lit(0))).alias("viewers"),
        only("like", F.coalesce(to_bigint(text("batch_count")), F.lit(1))).alias("taps"),
        only("like", to_bigint(text("total_room_likes"))).alias("room_likes"),
    )


def derive_sessions(envelope: DataFrame, gap_seconds: int = 900) -> DataFrame:
    """Sessions per streamer and category, a pause longer than ``gap_seconds`` ending one.

    Events less than a bucket apart are in one session whatever else happens, so each bucket of
    ``gap_seconds`` first shrinks to its bounds, combined on the map side. The window then sees at
    most one row per bucket of time, not the events.
    """
    timed = envelope.select("streamer", "category", event_time(F.col("received_at")).alias("ts"))
    bucketed = (
        timed.where(F.col("ts").isNotNull())
        .groupBy("streamer", "category", time_bucket(F.col("ts"), gap_seconds).alias("bucket"))
        .agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    )
    in_order = Window.partitionBy("streamer", "category").orderBy("bucket")
    pause = F.unix_micros("low") - F.unix_micros(F.lag("high").over(in_order))
    opens = F.coalesce(pause > gap_seconds * 1_000_000, F.lit(True))
    numbered = bucketed.withColumn("opens", opens.cast("int")).withColumn(
        "number", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy("streamer", "category", "number")
        .agg(F.min("low").alias("session_start"), F.max("high").alias("session_end"))
        .drop("number")
    )


def _in_sessions(events: DataFrame, sessions: DataFrame) -> DataFrame:
    return events_within(
        events, sessions.select(*SESSION), key="streamer", ts="ts",
        start="session_start", end="session_end", bucket_seconds=HOUR,
    )


def session_summary(envelope: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Totals and burn rates per streamer, or per given session.

    Diamonds count final gifts only. Money is the reported value where there is one, else the diamonds
    at the fixed rate; whole diamonds are summed first and priced once. Of simultaneous readings of
    viewers or likes, any one may be the last.
    """
    events = activity(envelope).where(F.col("ts").isNotNull()).drop("category", "gifter", "gift_name")
    if sessions is None:
        keys = ["streamer"]
        bounds = [F.min("ts").alias("session_start"), F.max("ts").alias("session_end")]
    else:
        keys, bounds = list(SESSION), []
        # The sessions themselves join as empty rows, so that a silent one gets its zeros.
        events = _in_sessions(events, sessions).unionByName(
            sessions.select(*SESSION), allowMissingColumns=True
        )
    return with_rates(events.groupBy(*keys).agg(*bounds, *session_sums(), *[
        F.coalesce(_last(value), F.lit(0)).alias(name) for name, value in LAST_READINGS.items()
    ]))


def session_sums() -> list[Column]:
    """What adds up over a session's events."""
    final = F.col("is_final")
    unpriced = final & F.col("usd_value").isNull()
    return [
        F.coalesce(F.sum(F.when(final, F.col("coins"))), F.lit(0)).alias("total_diamonds"),
        F.coalesce(F.sum(F.when(final, F.col("usd_value"))), F.lit(0.0)).alias("priced"),
        F.coalesce(F.sum(F.when(unpriced, F.col("coins"))), F.lit(0)).alias("unpriced"),
        F.count_if(F.col("event_type") == "comment").alias("total_comments"),
    ]


def with_rates(totals: DataFrame) -> DataFrame:
    """Money, duration and rates per minute from a session's sums and bounds."""
    usd = F.col("priced") + F.col("unpriced") * F.lit(0.005)
    seconds = seconds_between(F.col("session_start"), F.col("session_end"))

    def per_minute(total: str) -> Column:
        rate = F.col(total) / (F.col("duration_seconds") / 60.0)
        return F.when(F.col("duration_seconds") > 0, rate).otherwise(F.lit(0.0))

    return (
        totals.withColumns({"total_usd": usd, "duration_seconds": seconds})
        .drop("priced", "unpriced")
        .withColumns(
            {"diamonds_per_min": per_minute("total_diamonds"), "usd_per_min": per_minute("total_usd")}
        )
    )


def _last(value: str) -> Column:
    """The value at the latest time; fixed-width buffers, so Spark hashes."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col("ts")))


def session_top(envelope: DataFrame, by: str = "gift", n: int | None = None,
                sessions: DataFrame | None = None) -> DataFrame:
    """Per streamer (or session) the top gifts by repeats, or the top gifters by diamonds.

    The rank filter lets Spark keep n rows per group in every task before it shuffles.
    """
    if by not in ("gift", "gifter"):
        raise ValueError(f"by must be 'gift' or 'gifter', not {by!r}")
    column, measure, total, limit = (
        ("gift_name", "repeat_count", "times", 5) if by == "gift" else ("gifter", "coins", "diamonds", 3)
    )
    final = activity(envelope).where(F.col("is_final") & F.col("ts").isNotNull())
    keys = ["streamer"]
    final = final.select("streamer", "ts", column, measure)
    if sessions is not None:
        keys = list(SESSION)
        final = _in_sessions(final, sessions)
    summed = final.groupBy(*keys, column).agg(F.sum(measure).alias(total))
    best_first = Window.partitionBy(*keys).orderBy(
        F.col(total).desc_nulls_last(), F.col(column).asc_nulls_last()
    )
    top = summed.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= (n or limit))
    if by == "gifter":
        top = top.withColumn("approx_usd", in_usd(F.col("diamonds")))
    return top


def like_closings(likes: DataFrame, bucket_seconds: int = LIKE_BUCKET, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """(streamer, bucket, closing, closing_at): the last known room like total of each bucket of time, and its place."""
    total = F.col("total_room_likes")
    place = F.struct("event_timestamp", *tie_break) if tie_break else F.col("event_timestamp")
    known = F.when(total.isNotNull(), place)
    return likes.groupBy("streamer", time_bucket(F.col("event_timestamp"), bucket_seconds).alias("bucket")).agg(
        F.max_by(total, known).alias("closing"), F.max(known).alias("closing_at")
    )


def carry_like_total(likes: DataFrame, bucket_seconds: int = LIKE_BUCKET, tie_break: tuple[str, ...] = (),
                     earlier: DataFrame | None = None) -> DataFrame:
    """Fill an absent room like total with the streamer's previous one, 0 before the first.

    Within a time bucket a window looks back; across buckets only each bucket's last total travels.
    So the unbounded look-back runs over one row per bucket of time. ``earlier`` (streamer, bucket, closing) brings the
    closings of buckets that ``likes`` has no rows of.
    """
    bucketed = likes.withColumn("_bucket", time_bucket(F.col("event_timestamp"), bucket_seconds))
    order = ["event_timestamp", *tie_break]
    inside = (
        Window.partitionBy("streamer", "_bucket").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.col("total_room_likes")
    seen = bucketed.withColumn("_seen", F.last(total, ignorenulls=True).over(inside))
    position = F.struct(*order) if tie_break else F.col("event_timestamp")
    closing = bucketed.groupBy("streamer", "_bucket").agg(
        F.max_by(total, F.when(total.isNotNull(), position)).alias("_closing")
    )
    before = (
        Window.partitionBy("streamer").orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    if earlier is not None:
        closing = closing.unionByName(
            earlier.select("streamer", F.col("bucket").alias("_bucket"), F.col("closing").alias("_closing"))
        )
    carried = closing.select(
        "streamer", "_bucket", F.last("_closing", ignorenulls=True).over(before).alias("_carried")
    )
    return (
        seen.join(carried, ["streamer", "_bucket"], "left")
        .withColumn("total_room_likes", F.coalesce("_seen", "_carried", F.lit(0)))
        .drop("_bucket", "_seen", "_carried")
    )

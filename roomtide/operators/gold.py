"""Reports and views over envelopes and typed tables.

All of them are plain group-bys: Spark combines on the map side, so a hot streamer costs one partial
row per task, and the top-n reports keep n rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.functions.casts import event_time

USD_PER_DIAMOND = "0.005"  # exact text: money is rounded in decimal, not in binary


def _order(*descending: str, then: tuple[str, ...]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in descending] + [F.col(c).asc_nulls_last() for c in then]


def _coins() -> Column:
    return F.col("diamond_count") * F.col("repeat_count")


def in_usd(diamonds: Column, rate: str | float = USD_PER_DIAMOND) -> Column:
    exact = F.lit(str(rate)).cast("decimal(18,9)")
    return F.round(diamonds.cast("decimal(20,0)") * exact, 2).cast("double")


def _handle(df: DataFrame) -> Column:
    return F.col("unique_id" if "unique_id" in df.columns else "user_handle")


def event_types(envelope: DataFrame) -> DataFrame:
    return envelope.select("event_type").distinct()


def event_breakdown(envelope: DataFrame) -> DataFrame:
    counted = envelope.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.orderBy(*_order("cnt", then=("event_type",)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def event_overview(envelope: DataFrame) -> DataFrame:
    """Volume and time span per event type.

    The span is taken on the parsed instant: it agrees with the order of the capture clients' texts and
    keeps the aggregation buffer fixed-width, so Spark can hash instead of sort.
    """
    timed = envelope.select("event_type", event_time(F.col("received_at")).alias("ts"))
    return (
        timed.groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.min("ts").alias("first_event"),
            F.max("ts").alias("last_event"),
        )
        .orderBy(*_order("total_records", then=("event_type",)))
    )


def viewer_metrics(rooms: DataFrame) -> DataFrame:
    return rooms.groupBy("streamer").agg(
        F.min("viewer_count").alias("min_viewers"),
        F.round(F.avg("viewer_count"), 1).alias("avg_viewers"),
        F.max("viewer_count").alias("peak_viewers"),
        F.count(F.lit(1)).alias("snapshot_intervals"),
    )


def top_likers(likes: DataFrame, n: int = 5) -> DataFrame:
    return (
        likes.groupBy(_handle(likes).alias("user_handle"))
        .agg(
            F.sum("batch_count").alias("total_taps_contributed"),
            F.count(F.lit(1)).alias("tap_batches_sent"),
            F.round(F.avg("batch_count"), 1).alias("avg_batch_size"),
        )
        .orderBy(*_order("total_taps_contributed", then=("user_handle",)))
        .limit(n)
    )


def top_commenters(comments: DataFrame, n: int = 5) -> DataFrame:
    return (
        comments.groupBy(_handle(comments).alias("user_handle"))
        .agg(F.count(F.lit(1)).alias("total_comments"))
        .orderBy(*_order("total_comments", then=("user_handle",)))
        .limit(n)
    )


def gift_revenue(gifts: DataFrame, usd_rate: str | float = USD_PER_DIAMOND) -> DataFrame:
    """Final gifts by name; a gift in mid-combo does not count."""
    return (
        gifts.where(~F.col("is_streaking"))
        .groupBy("gift_name")
        .agg(F.count(F.lit(1)).alias("times_sent"), F.sum(_coins()).alias("total_diamonds"))
        .withColumn("approx_usd", in_usd(F.col("total_diamonds"), usd_rate))
        .orderBy(*_order("total_diamonds", then=("gift_name",)))
    )


def whale_analytics(gifts: DataFrame, category: str = "npc") -> DataFrame:
    """How far a streamer depends on the one biggest spender.

    The first group-by already has one row per spender, so counting rows replaces a distinct count.
    """
    per_user = (
        gifts.where((F.col("category") == category) & ~F.col("is_streaking"))
        .groupBy("streamer", "archetype", _handle(gifts).alias("gifter"))
        .agg(F.sum(_coins()).alias("user_diamonds"))
    )
    return whales_of(per_user)


def whales_of(per_user: DataFrame) -> DataFrame:
    """The view from one row (streamer, archetype, gifter, user_diamonds) per spender."""
    share = F.try_divide(F.col("top_whale_diamonds"), F.col("total_diamonds")) * 100
    return (
        per_user.groupBy("streamer", "archetype")
        .agg(
            F.count("gifter").alias("total_unique_gifters"),
            F.sum("user_diamonds").alias("total_diamonds"),
            F.max("user_diamonds").alias("top_whale_diamonds"),
        )
        .withColumn("top_whale_revenue_share_pct", F.round(share, 2))
        .orderBy(*_order("total_diamonds", then=("streamer", "archetype")))
    )


def streak_dynamics(gifts: DataFrame, category: str = "npc") -> DataFrame:
    return ordered_streaks(
        gifts.where((F.col("category") == category) & F.col("is_repeat_end"))
        .groupBy("streamer", "archetype", "gift_name")
        .agg(
            F.count(F.lit(1)).alias("total_gift_events"),
            F.avg("repeat_count").alias("avg_combo_streak"),
            F.max("repeat_count").alias("max_combo_streak"),
            F.sum(_coins()).alias("total_diamonds_generated"),
        )
    )


def ordered_streaks(streaks: DataFrame) -> DataFrame:
    return streaks.orderBy(*_order("total_diamonds_generated", then=("streamer", "archetype", "gift_name")))


def vertical_performance(pins: DataFrame, category: str = "ecommerce") -> DataFrame:
    return ordered_verticals(
        pins.where(F.col("category") == category)
        .groupBy(F.col("archetype").alias("product_category"), "streamer")
        .agg(
            F.countDistinct("product_id").alias("unique_products_showcased"),
            F.count(F.lit(1)).alias("total_pin_events"),
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_last_pin"),
        )
    )


def ordered_verticals(verticals: DataFrame) -> DataFrame:
    return verticals.orderBy(*_order("total_pin_events", then=("product_category", "streamer")))


def create_gold_views(spark: SparkSession, gifts: DataFrame, pins: DataFrame) -> list[str]:
    """Register the three views for SQL users; they are computed on read."""
    views = {
        "npc_whale_analytics": whale_analytics(gifts),
        "npc_streak_dynamics": streak_dynamics(gifts),
        "ecommerce_vertical_performance": vertical_performance(pins),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)

"""The three gold views over live tables, kept up by the stream instead of recounted on every read.

Each micro-batch writes partial aggregates on the views' inner keys (spender, gift name, product) and month, in a folder of
the batch that a replay replaces. Partial aggregates merge: sums add up, extremes stay extreme, and a distinct product is
a key of its own, so its count is exact. Reading merges the partials, of which there are as many as inner keys, not as
events; folding (``compact_view``) merges those of finished batches by month and level, as for live tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.functions.timeparts import utc, yyyymm
from roomtide.operators import gold
from roomtide.operators.silver import typed
from roomtide.schemas import ENVELOPE, TABLES
from roomtide.sinks.months import drop_months, finished_batch, fold_months, read_months
from roomtide.streaming.live import read_live


@dataclass(frozen=True)
class View:
    """``partial`` makes partial aggregates of typed live rows with a month, ``merge`` adds partials up on ``keys``."""

    kind: str
    category: str
    keys: tuple[str, ...]
    chosen: Callable[[], Column]
    measures: Callable[[], dict[str, Column]]
    merged: dict[str, Callable[[str], Column]]
    finish: Callable[[DataFrame], DataFrame]

    def partial(self, rows: DataFrame) -> DataFrame:
        return rows.where(self.chosen()).groupBy("yyyymm", *self.keys).agg(*[m.alias(n) for n, m in self.measures().items()])

    def merge(self, partials: DataFrame, months: bool = True) -> DataFrame:
        keys = (["yyyymm"] if months else []) + list(self.keys)
        return partials.groupBy(*keys).agg(*[add(name).alias(name) for name, add in self.merged.items()])


def _coins() -> Column:
    return F.sum(F.col("diamond_count") * F.col("repeat_count"))


VIEWS = {
    "npc_whale_analytics": View(
        "gift", "npc", ("category", "streamer", "archetype", "unique_id"), lambda: ~F.col("is_streaking"),
        lambda: {"user_diamonds": _coins()}, {"user_diamonds": F.sum},
        lambda rows: gold.whales_of(rows.withColumnRenamed("unique_id", "gifter")),
    ),
    "npc_streak_dynamics": View(
        "gift", "npc", ("category", "streamer", "archetype", "gift_name"), lambda: F.col("is_repeat_end"),
        lambda: {
            "n": F.count(F.lit(1)), "repeats": F.sum("repeat_count"), "longest": F.max("repeat_count"), "diamonds": _coins(),
        },
        {"n": F.sum, "repeats": F.sum, "longest": F.max, "diamonds": F.sum},
        lambda rows: gold.ordered_streaks(rows.select(
            "streamer", "archetype", "gift_name", F.col("n").alias("total_gift_events"),
            (F.col("repeats").cast("double") / F.col("n")).alias("avg_combo_streak"),
            F.col("longest").alias("max_combo_streak"), F.col("diamonds").alias("total_diamonds_generated"),
        )),
    ),
    "ecommerce_vertical_performance": View(
        "product_pin", "ecommerce", ("category", "archetype", "streamer", "product_id"), lambda: F.lit(True),
        lambda: {"pins": F.count(F.lit(1)), "first_pin": F.min("event_timestamp"), "last_pin": F.max("event_timestamp")},
        {"pins": F.sum, "first_pin": F.min, "last_pin": F.max},
        lambda rows: gold.ordered_verticals(
            rows.groupBy(F.col("archetype").alias("product_category"), "streamer").agg(
                F.count("product_id").alias("unique_products_showcased"), F.sum("pins").alias("total_pin_events"),
                F.min("first_pin").alias("session_start"), F.max("last_pin").alias("session_last_pin"),
            )
        ),
    ),
}


def _path(out_root: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/views/{name}"


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("yyyymm", yyyymm(F.col("event_timestamp")))


def write_partials(envelope: DataFrame, out_root: str, batch_id: int) -> None:
    """The partial aggregates of one micro-batch, for all views."""
    for name, view in VIEWS.items():
        (
            view.partial(_with_month(typed(envelope, view.kind, "live")))
            .withColumn("batch_id", F.lit(batch_id))
            .hint("rebalance", F.col("yyyymm"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("yyyymm", "batch_id")
            .parquet(_path(out_root, name))
        )


def _columns(spark: SparkSession, name: str):
    view = VIEWS[name]
    empty = spark.createDataFrame([], ENVELOPE)
    return view.partial(_with_month(typed(empty, view.kind, "live"))).schema


def read_partials(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    return read_months(spark, _path(out_root, name), _columns(spark, name))


def read_view(spark: SparkSession, out_root: str, name: str, category: str | None = None, since: datetime | None = None) -> DataFrame:
    """A view as of now, from partials alone.

    ``since`` leaves out older events: whole months by their partials; only the month of the cut is counted from the
    live table's rows.
    """
    view = VIEWS[name]
    partials = read_partials(spark, out_root, name)
    if since is not None:
        cut = F.lit(utc(since))
        partials = partials.where(F.col("yyyymm") > yyyymm(cut))
        rows = read_live(spark, out_root, TABLES[view.kind])
        rows = rows.where((F.col("yyyymm") == yyyymm(cut)) & (F.col("event_timestamp") >= cut))
        partials = partials.unionByName(view.partial(rows))
    wanted = partials.where(F.col("category") == (category or view.category))
    return view.finish(view.merge(wanted, months=False))


def compact_view(spark: SparkSession, out_root: str, name: str, upto: int, checkpoint: str | None = None) -> list[str]:
    """Merge the partials of all batches up to ``upto``, a finished one; gives the months that changed."""
    if checkpoint is not None and upto > finished_batch(spark, checkpoint):
        raise ValueError(f"batch {upto} is not finished")
    return fold_months(spark, _path(out_root, name), _columns(spark, name), upto, VIEWS[name].merge)


def drop_view_months(spark: SparkSession, out_root: str, name: str, expired: Callable[[str], bool]) -> list[str]:
    """Take expired months out of a view; the month of a cut is handled by ``read_view`` with ``since``."""
    return drop_months(spark, _path(out_root, name), expired)

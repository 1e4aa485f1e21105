"""One year of live data: the cut on read and the removal of expired months."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.functions.timeparts import utc, yyyymm
from roomtide.sinks.months import drop_months, fold_months, manifests
from roomtide.streaming.live import live_columns, sorted_months

KEEP = "1 year"


def retained(table: DataFrame, now: Column, keep: str = KEEP) -> DataFrame:
    """Rows younger than ``keep``; where the table has month folders, older ones are not read."""
    cutoff = now - F.expr(f"interval {keep}")
    kept = table.where(F.col("event_timestamp") >= cutoff)
    if "yyyymm" in table.columns:
        kept = kept.where(F.col("yyyymm").cast("string") >= yyyymm(cutoff))
    return kept


def expired_months(months: list[str], now: datetime, years: int = 1) -> list[str]:
    """The months whose last instant is older than ``years`` before ``now``."""
    cutoff = f"{now.year - years:04d}{now.month:02d}"
    return sorted(m for m in months if m < cutoff)


def drop_expired(spark: SparkSession, out_root: str, table: str, now: datetime, years: int = 1) -> list[str]:
    """Take what is older than ``years`` before ``now`` out of a live table; gives the months removed.

    Months that have wholly expired go, folded or not. Of the month in which the cut lies, the runs are written again
    without the expired rows; its open batches lose theirs when they are folded (``compact_live`` with
    ``expire_before``). ``retained`` cuts exactly on read.
    """
    path = f"{out_root.rstrip('/')}/{table}"
    gone = drop_months(spark, path, lambda month: month.isdigit() and bool(expired_months([month], now, years)))
    cut = years_before(now, years)
    month = f"yyyymm={cut.year:04d}{cut.month:02d}"
    runs = [r["path"] for r in manifests(spark, path).get(month, {"runs": []})["runs"]]
    columns = live_columns(spark, table)
    if runs:
        rows = spark.read.schema(columns).parquet(*[f"{path}_runs/{r}" for r in runs])
        if rows.where(F.col("event_timestamp") < F.lit(utc(cut))).limit(1).count():
            fold_months(spark, path, columns, -1, sorted_months(table, cut), whole=[month])
    return gone


def years_before(now: datetime, years: int) -> datetime:
    """The same day and time ``years`` ago, or the last day of a shorter month."""
    try:
        return now.replace(year=now.year - years)
    except ValueError:
        return now.replace(year=now.year - years, day=28)

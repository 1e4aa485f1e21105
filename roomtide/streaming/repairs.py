"""Correction of quarantined lines: each is replayed once, and leaves the quarantine.

A repair routes corrected lines like a micro-batch, below ``out_root``/repairs, which has live tables of its own, and then
lists what it has repaired by batch and digest of the line. The list is written last and numbers the repairs, so one that
fails is done again under its number, and one that is repeated finds nothing left to do.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.sinks.folders import child_names
from roomtide.sources.envelopes import parse_envelopes
from roomtide.streaming.live import live_columns, read_live, read_quarantine, route_batch

REPAIRED = "line string, batch_id bigint, lines bigint, repair bigint"


def _root(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/repairs"


def _repairs(spark: SparkSession, out_root: str) -> list[int]:
    """The repairs that have been finished."""
    root = f"{_root(out_root)}/repaired"
    names = [n for n in child_names(spark, root) if n.startswith("repair=")]
    return sorted(int(n.removeprefix("repair=")) for n in names if "_SUCCESS" in child_names(spark, f"{root}/{n}"))


def _shuffled(lines: DataFrame) -> DataFrame:
    """One row for each of many lines. Packed files and shuffles let Spark take them for small, so the hint keeps them
    from being broadcast through the driver."""
    return lines.hint("merge")


def repaired_lines(spark: SparkSession, out_root: str) -> DataFrame:
    """(line, batch_id, lines, repair): digest and batch of repaired lines, and how often the batch had them."""
    folders = [f"{_root(out_root)}/repaired/repair={n}" for n in _repairs(spark, out_root)]
    if not folders:
        return spark.createDataFrame([], REPAIRED)
    return spark.read.schema(REPAIRED).option("basePath", f"{_root(out_root)}/repaired").parquet(*folders)


def waiting(spark: SparkSession, out_root: str) -> DataFrame:
    """The quarantine without what has been repaired: raw, reason, batch_id."""
    held = read_quarantine(spark, out_root).withColumn("line", F.sha2("raw", 256))
    repaired = repaired_lines(spark, out_root).select("line", "batch_id")
    return held.join(_shuffled(repaired), ["line", "batch_id"], "left_anti").drop("line")


def repair_quarantine(spark: SparkSession, out_root: str, corrected: DataFrame) -> int:
    """Replay the waiting lines that ``corrected`` (raw, value) has a readable value for; gives how many there were.

    A line that waits several times is replayed as often. Of several values for a line the least readable one is taken.
    One repair at a time.
    """
    done = _repairs(spark, out_root)
    number = done[-1] + 1 if done else 0
    held = waiting(spark, out_root).groupBy(F.sha2("raw", 256).alias("line"), "batch_id").agg(F.count(F.lit(1)).alias("lines"))
    wanted = corrected.withColumn("line", F.sha2("raw", 256)).join(_shuffled(held.select("line")), "line", "left_semi")
    readable = parse_envelopes(wanted, keep=("line",)).where(F.col("problem").isNull())
    fixes = readable.groupBy("line").agg(F.min("raw").alias("value"))
    matched = held.join(_shuffled(fixes), "line").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        each = matched.select("value", F.explode(F.sequence(F.lit(1), F.col("lines").cast("int")))).select("value")
        route_batch(each, number, _root(out_root))
        folder = f"{_root(out_root)}/repaired/repair={number}"
        matched.select("line", "batch_id", "lines").write.mode("overwrite").parquet(folder)
    finally:
        matched.unpersist()
    return spark.read.schema("line string, batch_id bigint, lines bigint").parquet(folder).agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]


def read_with_repairs(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """A live table with the rows that repairs have added; an unfinished repair's rows are not among them."""
    rows, done = read_live(spark, out_root, table), _repairs(spark, out_root)
    if not done:
        return rows
    columns = live_columns(spark, table).add("batch_id", "long")
    folder = f"{_root(out_root)}/{table}"
    if not child_names(spark, folder):
        return rows
    added = spark.read.schema(columns).parquet(folder).where(F.col("batch_id") <= done[-1]).drop("batch_id")
    return rows.unionByName(added)

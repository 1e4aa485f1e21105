"""One day of the archive into typed, partitioned tables.

A run writes its tables beside those of the run before, each below the day's folder in one of its own (run=R), and then
publishes the day: a small file, written whole or not at all, that names the run. Readers follow it, so a day is as it
was until the new one is complete, in all tables at once; a run that fails leaves nothing that is read.
"""

from __future__ import annotations

import json
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.operators.silver import typed
from roomtide.schemas import ENVELOPE, TABLES
from roomtide.sinks.folders import child_names, delete_folder, read_text, write_text
from roomtide.sinks.tables import write_day
from roomtide.sources.archive import ANY_TOPIC, day_parts, read_day, read_undated
from roomtide.sources.envelopes import MALFORMED, good, parse_envelopes, quarantined, well_formed

SUMMARY = "date string, item string, rows bigint, path string"


def nightly_tables(envelope: DataFrame) -> dict[str, DataFrame]:
    return {table: typed(envelope, kind, "batch") for kind, table in TABLES.items()}


def day_folder(root: str, table: str, day: str) -> str:
    dated = "/".join(f"{k}={v}" for k, v in day_parts(day).items())
    return f"{root.rstrip('/')}/silver/{table}/{dated}"


def _pointers(spark: SparkSession, root: str, day: str) -> list[str]:
    """What has been published of a day, newest first."""
    names = child_names(spark, f"{root.rstrip('/')}/silver/_days/{day}")
    return sorted((n for n in names if n.isdigit()), reverse=True)


def published(spark: SparkSession, root: str, day: str) -> dict:
    """The run that readers of a day take and the tables it has; without a run the day has none."""
    versions = _pointers(spark, root, day)
    if not versions:
        return {"run": None, "tables": []}
    return json.loads(read_text(spark, f"{root.rstrip('/')}/silver/_days/{day}/{versions[0]}"))


def _publish(spark: SparkSession, root: str, day: str, run: str, tables: list[str]) -> None:
    """Point readers of the day to ``run``, then delete what other runs have left of it."""
    versions, folder = _pointers(spark, root, day), f"{root.rstrip('/')}/silver/_days/{day}"
    number = int(versions[0]) + 1 if versions else 0
    write_text(spark, f"{folder}/{number:012d}", json.dumps({"run": run, "tables": tables}))
    for version in versions:
        delete_folder(spark, f"{folder}/{version}")
    for table in (*TABLES.values(), "quarantine"):
        path = day_folder(root, table, day)
        for name in child_names(spark, path):
            if name != f"run={run}":
                delete_folder(spark, f"{path}/{name}")
        if table not in tables:
            delete_folder(spark, path)


def run_nightly(spark: SparkSession, lake_root: str, date: str, dry_run: bool = False,
                out_root: str | None = None, topics: str = ANY_TOPIC) -> DataFrame:
    """Type the archive of ``date`` and replace that day's tables; gives a summary row per table.

    The text is parsed once and kept for the counts and the writes; lost blocks are parsed anew. A
    table without rows has no folder for the day: one of an earlier run goes. A dry run writes nothing and
    counts all event types instead. Undated and unreadable lines go to a quarantine folder of the day.
    One run of a day at a time.
    """
    root, run = out_root or lake_root, uuid.uuid4().hex[:12]
    lines = read_day(spark, lake_root, date, topics)
    if lines is None:
        if not dry_run and published(spark, root, date)["tables"]:
            _publish(spark, root, date, run, [])
        return spark.createDataFrame([], SUMMARY)
    if dry_run:
        return _type_counts(well_formed(parse_envelopes(lines)), date)
    # A line's text is kept only where it goes to the quarantine.
    parsed = parse_envelopes(lines)
    parsed = parsed.withColumn("raw", F.when(F.col("problem").isNotNull(), F.col("raw"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = _counts(parsed)
        full = [name for name in (*TABLES.values(), "quarantine") if counts[name]]
        summary = [(date, "total", counts["total"], None)]
        envelope = good(parsed)
        for kind, table in TABLES.items():
            path = None
            if counts[table]:
                path = f"{day_folder(root, table, date)}/run={run}"
                write_day(typed(envelope, kind, "batch"), path)
            summary.append((date, table, counts[table], path))
        if counts["quarantine"]:
            path = f"{day_folder(root, 'quarantine', date)}/run={run}"
            quarantined(parsed).write.mode("overwrite").partitionBy("reason").parquet(path)
            summary.append((date, "quarantine", counts["quarantine"], path))
        if full or published(spark, root, date)["tables"]:
            _publish(spark, root, date, run, full)
        return spark.createDataFrame(summary if counts["total"] + counts["quarantine"] else [], SUMMARY)
    finally:
        parsed.unpersist()


def run_undated(spark: SparkSession, lake_root: str, out_root: str | None = None, topics: str = ANY_TOPIC) -> int:
    """Quarantine the archived messages without a readable time; gives their number.

    They belong to no day, so they have a folder of their own, which every run replaces as a whole.
    """
    path = f"{(out_root or lake_root).rstrip('/')}/silver/quarantine_undated"
    lines = read_undated(spark, lake_root, topics)
    if lines is None:
        delete_folder(spark, path)
        return 0
    quarantined(parse_envelopes(lines)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).count()


def read_undated_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("raw string, reason string").parquet(f"{root.rstrip('/')}/silver/quarantine_undated")


def _type_counts(events: DataFrame, day: str) -> DataFrame:
    """The total and the count of each event type, in one aggregation."""
    counted = events.rollup("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.grouping("event_type").alias("all_types")
    )
    item = F.when(F.col("all_types") == 1, "total").otherwise(F.coalesce("event_type", F.lit("(none)")))
    found = counted.where(F.col("rows") > 0).orderBy(F.desc("all_types"), F.desc("rows"), "event_type")
    return found.select(
        F.lit(day).alias("date"), item.alias("item"), "rows", F.lit(None).cast("string").alias("path")
    )


def _counts(parsed: DataFrame) -> dict[str, int]:
    """Total and per-table counts in one aggregation with one result row."""
    ok = F.col("problem").isNull()
    row = parsed.agg(
        F.count_if(~F.col("problem").eqNullSafe(MALFORMED)).alias("total"),
        *[F.count_if(ok & (F.col("event_type") == kind)).alias(table) for kind, table in TABLES.items()],
        F.count_if(~ok).alias("quarantine"),
    ).first()
    return row.asDict()


def published_days(spark: SparkSession, root: str) -> dict[str, dict]:
    """What readers take of each day that has been published."""
    days = sorted(child_names(spark, f"{root.rstrip('/')}/silver/_days"))
    return {day: published(spark, root, day) for day in days}


def read_nightly(spark: SparkSession, root: str, table: str, days: list[str] | None = None) -> DataFrame:
    """A typed table over all its days, or ``days``; year, month, day, category and streamer prune folders.

    Partition values are text, so month=09 keeps its zero.
    """
    base = f"{root.rstrip('/')}/silver/{table}"
    kind = next(k for k, t in TABLES.items() if t == table)
    columns = typed(spark.createDataFrame([], ENVELOPE), kind, "batch").schema
    for part in ("year", "month", "day"):
        columns = columns.add(part, "string")
    found = published_days(spark, root) if days is None else {d: published(spark, root, d) for d in days}
    folders = [f"{day_folder(root, table, d)}/run={p['run']}" for d, p in found.items() if table in p["tables"]]
    if not folders:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("basePath", base).parquet(*folders).select(*columns.names)

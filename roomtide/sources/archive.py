"""The raw archive: where its files lie, and the scan of one day."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.functions.casts import event_time
from roomtide.functions.timeparts import hour_parts

# Writer and reader share this layout: <root>/topic=<topic>/year=/month=/day=/hour=
PARTITIONS = ("topic", "year", "month", "day", "hour")
ANY_TOPIC = "topic=*"


def one_line(value: Column) -> Column:
    """A message as one line of text. Valid JSON gets spaces for its line breaks; what else has some, or
    begins as a JSON string does, is stored as a JSON string, which :func:`as_received` undoes."""
    boxed = F.to_json(F.array(value))
    quoted = F.substring(boxed, F.lit(2), F.length(boxed) - 2)
    broken = value.rlike("[\r\n]")
    odd = value.startswith('"')
    as_json = F.when(F.try_parse_json(value).isNotNull() & ~odd, F.translate(value, "\r\n", "  "))
    return F.when(broken | odd, F.coalesce(as_json, quoted)).otherwise(value)


def as_received(line: Column) -> Column:
    """The message of a stored line."""
    unquoted = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>")
    return F.when(line.startswith('"'), F.coalesce(F.get(unquoted, F.lit(0)), line)).otherwise(line)


def archive_columns(topic: Column, received_at: Column) -> dict[str, Column]:
    return {"topic": topic, **hour_parts(event_time(received_at))}


def day_parts(day: str) -> dict[str, str]:
    """Zero-padded path values of a YYYY-MM-DD date."""
    parsed = date.fromisoformat(day)
    return {"year": f"{parsed:%Y}", "month": f"{parsed:%m}", "day": f"{parsed:%d}"}


def day_path(root: str, day: str, topics: str = ANY_TOPIC) -> str:
    dated = "/".join(f"{k}={v}" for k, v in day_parts(day).items())
    return f"{root.rstrip('/')}/{topics}/{dated}"


def read_day(spark: SparkSession, root: str, day: str, topics: str = ANY_TOPIC) -> DataFrame | None:
    """The raw lines of one day, all topics and hours; None when the archive has no such day.

    Only that day's folders are listed. ``topics`` is a glob, so archives that name the topic folder
    differently can be read as well.
    """
    try:
        lines = spark.read.option("recursiveFileLookup", "true").text(day_path(root, day, topics))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return lines.select(as_received(F.col("value")).alias("value"))


def read_undated(spark: SparkSession, root: str, topics: str = ANY_TOPIC) -> DataFrame | None:
    """The archived messages without a readable time, which no day's scan can reach; None if there are none."""
    try:
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{root.rstrip('/')}/{topics}/year=__HIVE_DEFAULT_PARTITION__")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return lines.select(as_received(F.col("value")).alias("value"))


def read_all_days(spark: SparkSession, root: str) -> DataFrame:
    """The whole archive with its partition columns as text, for filters that prune folders."""
    schema = "value string, " + ", ".join(f"{p} string" for p in PARTITIONS)
    stored = spark.read.schema(schema).text(root)
    return stored.select(as_received(F.col("value")).alias("value"), *[F.col(p) for p in PARTITIONS])

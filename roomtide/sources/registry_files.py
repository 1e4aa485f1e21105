"""Registry files: the single-document snapshot and our own record files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.operators.registry import fold_registry, seed_events
from roomtide.schemas import REGISTRY

_RECORD = (
    "struct<username:string,category:string,archetype:string,source:string,discovered_at:string,"
    "status:string,cooldown_until:string,blacklist_reason:string,first_seq:bigint,"
    "stats:struct<total_sessions:bigint,peak_viewers:bigint,total_diamonds_seen:bigint,"
    "last_live:string,last_checked:string>>"
)


def read_snapshot(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A snapshot of the form {"streamers": {username: record}}; the seeds when it is not there or not
    readable, and an empty pool when a readable one has no streamers.

    One JSON document is one task by nature; with ``multi_line=False`` there is one on each line, as ``write_snapshot``
    writes them. Times that cannot be read are NULL, so such a cooldown counts as over.
    """
    schema = f"streamers map<string,{_RECORD}>, _corrupt_record string"
    try:
        document = spark.read.option("multiLine", multi_line).schema(schema).json(path)
        # Both columns are asked for, since Spark refuses a query of the corrupt column alone.
        usable = document.agg(F.count_if(F.col("_corrupt_record").isNull()), F.count("streamers")).first()[0] > 0
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        usable = False
    if not usable:
        return fold_registry(seed_events(spark))
    records = document.select(F.posexplode("streamers").alias("place", "username", "r"))
    times = {"discovered_at", "cooldown_until", "last_live", "last_checked"}
    stats = {"total_sessions", "peak_viewers", "total_diamonds_seen", "last_live", "last_checked"}
    columns = []
    for field in REGISTRY.fields:
        if field.name == "username":
            column = F.col("username")
        elif field.name == "first_seq":
            column = F.coalesce("r.first_seq", "place")
        else:
            column = F.col(f"r.stats.{field.name}" if field.name in stats else f"r.{field.name}")
        if field.name in times:
            column = column.try_cast("timestamp")
        columns.append(column.cast(field.dataType).alias(field.name))
    defaults = {
        "archetype": F.coalesce("archetype", F.lit("general")),
        "status": F.coalesce("status", F.lit("candidate")),
        **{c: F.coalesce(c, F.lit(0)) for c in ("total_sessions", "peak_viewers", "total_diamonds_seen")},
    }
    return records.select(*columns).withColumns(defaults)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry as written by the record sink."""
    return spark.read.schema(REGISTRY).parquet(path)

"""The registry as record files, one row per creator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.functions.timeparts import iso_utc

TIMES = ("discovered_at", "cooldown_until", "last_live", "last_checked")


def snapshot_info(registry: DataFrame) -> DataFrame:
    return registry.agg(F.count(F.lit(1)).alias("total_streamers")).select(
        F.current_timestamp().alias("updated_at"), "total_streamers"
    )


def write_registry(registry: DataFrame, path: str) -> None:
    """Replace the registry at ``path``; rows stay spread over tasks, no document is built."""
    registry.write.mode("overwrite").parquet(path)


def snapshot_records(registry: DataFrame) -> DataFrame:
    """Each creator in the nested record form of the snapshot, as (username, record) text rows."""
    stats = F.struct("total_sessions", "peak_viewers", "total_diamonds_seen", "last_live", "last_checked")
    record = F.struct(
        "username", "category", "archetype", "source", "discovered_at", "status", "cooldown_until",
        "blacklist_reason", stats.alias("stats"),
    )
    return registry.select("username", F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))


def write_snapshot(registry: DataFrame, path: str, per_document: int = 10_000) -> None:
    """Replace the snapshot at ``path``: JSON documents of the form {"streamers": {username: record}}, one on each line.

    A document has some ``per_document`` creators, so no task holds the pool. Times are ISO text; a record tells its
    ``first_seq`` too, since the order of discovery goes over all documents.
    """
    documents = max(1, -(-registry.count() // per_document))
    text = registry.withColumns({c: iso_utc(F.col(c)) for c in TIMES})
    stats = F.struct("total_sessions", "peak_viewers", "total_diamonds_seen", "last_live", "last_checked")
    record = F.struct(
        "username", "category", "archetype", "source", "discovered_at", "status", "cooldown_until",
        "blacklist_reason", "first_seq", stats.alias("stats"),
    )
    entries = F.map_from_entries(F.collect_list(F.struct("username", record.alias("record"))))
    grouped = text.groupBy(F.pmod(F.xxhash64("username"), F.lit(documents)).alias("document")).agg(entries.alias("streamers"))
    grouped.select(F.to_json(F.struct("streamers"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)

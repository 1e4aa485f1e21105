"""Results of live checks: what they mean and which registry events they cause."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.operators.joins import join_unique
from roomtide.operators.registry import CHECK_ERROR_SECONDS, OFFLINE_SECONDS

# Error texts that rule a creator out for good, and the reason recorded.
FATAL_TEXTS = ("not capable of going live", "does not exist", "user_not_found")
FATAL_REASON = "incapable_of_live"


def classify_checks(checks: DataFrame) -> DataFrame:
    """Add outcome, op, delay_sec and reason to (username, is_live, error) rows.

    A live creator is to be captured and causes no registry event (``op`` NULL).
    """
    text = F.lower("error")
    fatal = F.lit(False)
    for phrase in FATAL_TEXTS:
        fatal = fatal | text.contains(phrase)
    outcome = (
        F.when(F.col("error").isNotNull(), F.when(fatal, "blacklist").otherwise("error"))
        .when(F.col("is_live"), "live")
        .otherwise("offline")
    )
    kind = F.col("outcome")
    return checks.withColumn("outcome", outcome).withColumns(
        {
            "op": F.when(kind == "blacklist", "invalid").when(kind != "live", "offline"),
            "delay_sec": F.when(kind == "offline", OFFLINE_SECONDS)
            .when(kind == "error", CHECK_ERROR_SECONDS)
            .cast("bigint"),
            "reason": F.when(kind == "blacklist", FATAL_REASON),
        }
    )


def check_events(checks: DataFrame) -> DataFrame:
    """The registry events of classified checks that carry ``seq`` and ``ts``."""
    caused = classify_checks(checks).where(F.col("op").isNotNull())
    return caused.withColumnRenamed("username", "handle")


def probe_events(checks: DataFrame) -> DataFrame:
    """As :func:`check_events` for a manual probe of the pool: only fatal errors change the registry."""
    return check_events(checks).where(F.col("op") == "invalid")


def live_summary(registry: DataFrame, checks: DataFrame) -> DataFrame:
    """How many of the registered creators are live; blacklisted ones are not probed.

    A creator counts once, by the latest check (``seq``). The total counts all of the registry.
    """
    wanted = registry.select("username", (F.coalesce("status", F.lit("candidate")) != "blacklisted").alias("probed"))
    latest = checks.groupBy(F.lower("username").alias("username")).agg(
        F.max_by(F.col("is_live") & F.col("error").isNull(), "seq").alias("live")
    )
    live = F.col("probed") & F.coalesce("live", F.lit(False))
    return join_unique(wanted, latest, "username", ["username"], "left").agg(
        F.count_if(live).alias("live_now"), F.count(F.lit(1)).alias("total_candidates")
    )

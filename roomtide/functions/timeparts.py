"""Partition values and ISO text of an event time (session time zone UTC)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def yyyymm(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def hour_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded text, so that month=09 keeps its zero in paths."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def utc(at: datetime) -> datetime:
    """A time without a zone is UTC, whatever the driver's zone."""
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)

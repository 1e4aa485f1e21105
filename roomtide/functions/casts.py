"""Text to number, flag and time, without ever failing a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_bigint(text: Column) -> Column:
    """Integer text; decimals and exponents round half away from zero ('5.7' -> 6, '1e3' -> 1000).

    The second branch is reached only by rows that the plain cast refuses.
    """
    return F.coalesce(
        text.try_cast("bigint"),
        F.round(text.try_cast("decimal(38,18)"), 0).try_cast("bigint"),
    )


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_flag(text: Column) -> Column:
    return text.try_cast("boolean")


def event_time(received_at: Column) -> Column:
    """The instant of an ISO-8601 text; its offset counts, and without one it is UTC, whatever the session says.

    NULL if it cannot be read or lacks a full date: a bare clock time is not today's.
    """
    text = F.trim(received_at)
    zoned = F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), F.concat(text, F.lit("T00:00:00Z"))).when(
        text.rlike(r"^\d{4}-\d\d-\d\d[T ][\d:.]+$"), F.concat(text, F.lit("Z"))
    )
    dated = F.when(text.rlike(r"^\d{4}-\d\d-\d\d[T ]"), text)
    return F.coalesce(zoned, dated).try_cast("timestamp")


def live_time(received_at: Column) -> Column:
    """As :func:`event_time`, whole seconds only."""
    return F.date_trunc("second", event_time(received_at))

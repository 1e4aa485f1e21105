"""Joins that keep their balance when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _salt(on: list[str], salts: int) -> Column:
    """A salt that depends on the row alone, so that a retried task puts it in the same place.

    The bit mask cannot be NULL, so Spark adds no filter that would compute the hash again.
    """
    if salts < 1 or salts & (salts - 1):
        raise ValueError(f"salts must be a power of two, not {salts}")
    return F.xxhash64(*[F.col(c) for c in on]).bitwiseAND(F.lit(salts - 1)).cast("int")


def _copied(df: DataFrame) -> DataFrame:
    """A side that an explode has multiplied. Spark estimates its size without the explode, so it must not
    be broadcast on that estimate: the hint keeps the join shuffled, and adaptive skew handling splits it."""
    return df.hint("merge")


def join_unique(big: DataFrame, unique: DataFrame, key: str, spread: list[str], how: str = "inner",
                salts: int = 1) -> DataFrame:
    """Join ``big`` to ``unique`` (one row per key).

    Without salts this is Spark's own join: broadcast where ``unique`` is measured small, else shuffled, and a
    hot key is split by adaptive skew handling. ``salts`` splits every key over that many tasks instead, at
    the price of as many copies of ``unique``; ``spread`` names columns of ``big`` that vary within a key.
    """
    if salts == 1:
        return big.join(unique, key, how)
    salted = big.withColumn("_salt", _salt(spread, salts))
    copies = unique.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(_copied(copies), [key, "_salt"], how).drop("_salt")


def time_bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def events_within(events: DataFrame, spans: DataFrame, *, key: str, ts: str, start: str, end: str,
                  bucket_seconds: int, salts: int = 1) -> DataFrame:
    """Events whose ``ts`` lies in a span of the same key, both ends included.

    A bare join on the key would meet every event of a hot key with every one of its spans in one
    task. Joined on (key, time bucket), a task sees a slice of time. A key that is hot within one bucket is
    split by adaptive skew handling, or by ``salts``, which copies the spans as often.
    """
    first, last = (time_bucket(F.col(c), bucket_seconds) for c in (start, end))
    placed = events.withColumn("_bucket", time_bucket(F.col(ts), bucket_seconds))
    copies = spans.where(F.col(start) <= F.col(end)).withColumn("_bucket", F.explode(F.sequence(first, last)))
    on = [key, "_bucket"]
    if salts > 1:
        placed = placed.withColumn("_salt", _salt([ts], salts))
        copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on.append("_salt")
    return (
        placed.join(_copied(copies), on)
        .where(F.col(ts).between(F.col(start), F.col(end)))
        .drop("_bucket", "_salt")
    )

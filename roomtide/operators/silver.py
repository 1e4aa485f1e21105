"""Typed tables out of the event envelope.

Three modes read the same payloads differently:

* ``batch``  keeps NULL for absent values, reads the legacy ``user`` key, keeps microseconds;
* ``local``  as batch, without category and archetype, and without pins;
* ``live``   puts '' / 0 / false for absent values, truncates the time to seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.functions.casts import event_time, live_time, to_bigint, to_double, to_flag
from roomtide.functions.identity import filled
from roomtide.schemas import LOCAL_KINDS, PAYLOADS, Field

MODES = ("batch", "live", "local")
PAYLOAD = "_payload"


def typed(envelope: DataFrame, kind: str, mode: str = "batch") -> DataFrame:
    """The rows of one event type as a typed table."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if kind not in (LOCAL_KINDS if mode == "local" else PAYLOADS):
        raise ValueError(f"no {mode} table for event type {kind!r}")
    # The type test comes first so that only matching payloads are parsed.
    rows = envelope.where(F.col("event_type") == kind)
    if mode == "live":
        return _live(rows, PAYLOADS[kind])
    return _batch(rows, PAYLOADS[kind], with_taxonomy=mode == "batch")


def with_payload_text(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add the payload's raw texts as columns ``_<key>`` (JSON null and absent -> NULL).

    One parse for all keys. ``json_tuple`` is a generator: Spark does not push later filters on its
    columns below it, which for a plain projection would mean a second parse inside the filter, while
    filters on the envelope still reach the scan.
    """
    names = [text_column(k) for k in keys]
    return rows.select("*", F.json_tuple("data", *keys).alias(*names))


def text_column(key: str) -> str:
    return f"_{key}"


def archetype_or_general() -> Column:
    return F.coalesce(filled(F.col("archetype")), F.lit("general"))


def _batch(rows: DataFrame, fields: tuple[Field, ...], with_taxonomy: bool) -> DataFrame:
    fields = tuple(f for f in fields if not f.live_only)
    keys = [k for f in fields for k in (f.key, f.legacy_key) if k]
    parsed = with_payload_text(rows, keys)
    taxonomy = [F.col("category"), archetype_or_general().alias("archetype")] if with_taxonomy else []
    return parsed.select(
        event_time(F.col("received_at")).alias("event_timestamp"),
        "streamer",
        *taxonomy,
        *[_batch_value(f).alias(f.name) for f in fields],
    )


def _batch_value(field: Field) -> Column:
    text = F.col(text_column(field.key))
    if field.legacy_key:
        text = F.coalesce(text, F.col(text_column(field.legacy_key)))
    if field.absent is not None:
        text = F.coalesce(text, F.lit(field.absent))
    match field.type:
        case "count" | "code":
            return to_bigint(text)
        case "number":
            return to_double(text)
        case "flag":
            return to_flag(text)
    return text


def _live(rows: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    # Text fields keep their JSON type. The one-row generator is there for the same reason as above.
    schema = ", ".join(f"`{f.key}` {'variant' if f.type == 'text' else 'string'}" for f in fields)
    payload = F.from_json("data", schema, {"mode": "PERMISSIVE"})
    parsed = rows.withColumn(PAYLOAD, F.explode(F.array(payload)))
    return parsed.select(
        live_time(F.col("received_at")).alias("event_timestamp"),
        F.coalesce("streamer", F.lit("")).alias("streamer"),
        F.coalesce("category", F.lit("")).alias("category"),
        archetype_or_general().alias("archetype"),
        *[_live_value(f).alias(f.live_name or f.name) for f in fields],
    )


def _live_value(field: Field) -> Column:
    value = F.col(f"{PAYLOAD}.{field.key}")
    match field.type:
        case "count":
            return F.greatest(F.coalesce(to_bigint(value), F.lit(0)), F.lit(0)).cast("bigint")
        case "code":
            return F.coalesce(to_bigint(value).try_cast("int"), F.lit(0))
        case "number":
            return F.coalesce(to_double(value), F.lit(0.0))
        case "flag":
            return F.coalesce(to_flag(value), F.lit(False))
    # Only a JSON string counts as text here: a number or object gives ''.
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string")).otherwise(F.lit(""))

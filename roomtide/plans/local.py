"""One JSONL file or folder in, typed tables and five reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomtide.operators import gold
from roomtide.operators.silver import typed
from roomtide.schemas import LOCAL_KINDS, TABLES
from roomtide.sinks.tables import export
from roomtide.sources.envelopes import good, quarantined, read_jsonl, well_formed


def local_tables(envelope: DataFrame) -> dict[str, DataFrame]:
    return {TABLES[kind]: typed(envelope, kind, "local") for kind in LOCAL_KINDS}


def reports(events: DataFrame, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "event_overview": gold.event_overview(events),
        "viewer_metrics": gold.viewer_metrics(tables["room_viewers"]),
        "top_likers": gold.top_likers(tables["likes"]),
        "gift_revenue": gold.gift_revenue(tables["gifts"]),
        "top_commenters": gold.top_commenters(tables["comments"]),
    }


def run_local(spark: SparkSession, input_path: str, out_dir: str | None = None,
              include_malformed: bool = False) -> dict[str, DataFrame]:
    """Typed tables, reports and the quarantine by name; the tables go to ``out_dir`` if one is given.

    A missing input stops the run. Without ``out_dir`` nothing runs until a result is used. With it,
    the reports read the typed columns back instead of parsing the text again. ``include_malformed``
    counts unreadable lines in the overview, under no type.
    """
    parsed = read_jsonl(spark, input_path)
    tables = local_tables(good(parsed))
    if out_dir:
        paths = export(tables, out_dir)
        tables = {
            name: spark.read.schema(df.schema).parquet(path)
            for (name, df), path in zip(tables.items(), paths)
        }
    events = well_formed(parsed, include_malformed)
    return {
        **{f"silver_{name}": df for name, df in tables.items()},
        **reports(events, tables),
        "event_types": gold.event_types(events),
        "quarantine": quarantined(parsed),
    }

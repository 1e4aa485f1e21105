"""Lines in, five live tables, a quarantine and an archive out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roomtide.functions.timeparts import utc
from roomtide.operators.silver import typed
from roomtide.schemas import ENVELOPE, LIVE_SORT, TABLES
from roomtide.sinks.archive import ROWS_PER_FILE, write_archive
from roomtide.sinks.months import finished_batch, fold_months, read_months
from roomtide.sinks.tables import write_live
from roomtide.sources.envelopes import parse_envelopes


def route_batch(lines: DataFrame, batch_id: int, out_root: str, max_bad_per_batch: int | None = None,
                also: Callable[[DataFrame, str, int], None] | None = None) -> None:
    """Type one micro-batch into the live tables.

    ``also`` gets the batch's good envelopes, ``out_root`` and the batch, to write what else is kept of a batch, such
    as the partial aggregates of ``views.write_partials``.

    Every write lies in a folder of the batch, so a replay after a failure replaces it. The batch is
    parsed once; unreadable and undated lines go to the quarantine, and ``max_bad_per_batch`` turns too
    many of them into an error.
    """
    parsed = parse_envelopes(lines).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if max_bad_per_batch is not None:
            bad = parsed.where(F.col("problem").isNotNull()).count()
            if bad > max_bad_per_batch:
                raise ValueError(f"batch {batch_id}: {bad} bad messages, {max_bad_per_batch} allowed")
        envelope = parsed.where(F.col("problem").isNull())
        for kind, table in TABLES.items():
            write_live(typed(envelope, kind, "live"), table, out_root, batch_id)
        if also is not None:
            also(envelope, out_root, batch_id)
        (
            parsed.where(F.col("problem").isNotNull())
            .select("raw", F.col("problem").alias("reason"), F.lit(batch_id).alias("batch_id"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(f"{out_root.rstrip('/')}/quarantine")
        )
    finally:
        parsed.unpersist()


def start_live(lines: DataFrame, out_root: str, checkpoint: str, every: str | None = None,
               max_bad_per_batch: int | None = None, optional_dedup: str | None = None,
               also: Callable[[DataFrame, str, int], None] | None = None) -> StreamingQuery:
    """Start the routing query on a stream of text lines (``value``).

    ``every`` is a processing-time interval; None handles what is there and stops.
    ``optional_dedup`` is a delay such as "10 minutes": messages repeated within it are dropped. It runs by
    the time of arrival, so no message is too late for it, whatever time it carries. The source keeps no
    message id, so equal text is the test, and it is off by default.
    """
    stream = lines.select("value")
    if optional_dedup:
        stream = (
            stream.withColumns({"arrived": F.current_timestamp(), "message": F.sha2("value", 256)})
            .withWatermark("arrived", optional_dedup)
            .dropDuplicatesWithinWatermark(["message"])
            .select("value")
        )

    def handle(batch: DataFrame, batch_id: int) -> None:
        route_batch(batch, batch_id, out_root, max_bad_per_batch, also)

    return _start(stream, handle, checkpoint, every)


def start_archive(messages: DataFrame, root: str, checkpoint: str, every: str | None = "5 minutes",
                  rows_per_file: int = ROWS_PER_FILE) -> StreamingQuery:
    """Archive (topic, value) messages as they came; a query and checkpoint of its own."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_archive(batch, root, batch_id, rows_per_file)

    return _start(messages.select("topic", "value"), handle, checkpoint, every)


def _start(stream: DataFrame, handle, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def live_columns(spark: SparkSession, table: str) -> T.StructType:
    """The columns of a live table with its month."""
    kind = next(k for k, t in TABLES.items() if t == table)
    return typed(spark.createDataFrame([], ENVELOPE), kind, "live").schema.add("yyyymm", "string")


def read_live(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """A live table with its month column: each month's runs and the batches behind them."""
    return read_months(spark, f"{out_root.rstrip('/')}/{table}", live_columns(spark, table))


def sorted_months(table: str, expire_before: datetime | None = None) -> Callable[[DataFrame], DataFrame]:
    """How a live table's rows are laid out in runs; rows from before ``expire_before`` are left out."""

    def lay_out(rows: DataFrame) -> DataFrame:
        if expire_before is not None:
            rows = rows.where(F.col("event_timestamp") >= F.lit(utc(expire_before)))
        return rows.hint("rebalance", F.col("yyyymm"), F.col("streamer")).sortWithinPartitions("yyyymm", *LIVE_SORT[table])

    return lay_out


def compact_live(spark: SparkSession, out_root: str, table: str, upto: int, checkpoint: str | None = None,
                 expire_before: datetime | None = None) -> list[str]:
    """Fold all batches up to ``upto`` into sorted runs by month and level; gives the months that changed.

    ``upto`` must be a batch that the stream has finished, which is checked where ``checkpoint`` names the stream's.
    Cost goes with the new batches and their months; other months' files stay as they are. Readers see each row once
    before, during and after; a replay of a folded batch is not seen twice. ``expire_before`` leaves out older rows.
    """
    if checkpoint is not None and upto > finished_batch(spark, checkpoint):
        raise ValueError(f"batch {upto} is not finished")
    path = f"{out_root.rstrip('/')}/{table}"
    return fold_months(spark, path, live_columns(spark, table), upto, sorted_months(table, expire_before))


def read_quarantine(spark: SparkSession, out_root: str) -> DataFrame:
    schema = "raw string, reason string, batch_id bigint"
    return spark.read.schema(schema).parquet(f"{out_root.rstrip('/')}/quarantine")

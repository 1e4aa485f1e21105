"""The registry kept up to date by a stream of its events.

The pool is laid out in buckets by the hash of the username. A batch reads and writes the buckets of the creators it
names, all others stay as they are: ``root``/batch=N/bucket=B holds what batch N has written, and a small manifest of
each batch says for every bucket which batch has written it last. Readers take the newest manifest, so they see a batch
whole or not at all.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomtide.operators.registry import as_registry_events, event_username, fold_registry
from roomtide.schemas import REGISTRY
from roomtide.sinks.folders import child_names, delete_folder, read_text, write_text

KEPT_VERSIONS = 10
BUCKETS = 256
MANIFESTS = "_manifests"  # the leading underscore hides the folder from readers of the whole root


def _bucket(username: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(username), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The batches that have a manifest, newest first."""
    names = child_names(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _manifest(spark: SparkSession, root: str, batch_id: int) -> dict:
    return json.loads(read_text(spark, f"{root.rstrip('/')}/{MANIFESTS}/{batch_id}"))


def _folder(bucket: str, batch_id: int) -> str:
    return f"batch={batch_id}/bucket={bucket}"


def _read(spark: SparkSession, root: str, written: dict[str, int]) -> DataFrame:
    """The rows of buckets, each as its batch has written it."""
    root = root.rstrip("/")
    folders = [f"{root}/{_folder(b, n)}" for b, n in written.items()]
    if not folders:
        return spark.createDataFrame([], REGISTRY)
    return spark.read.schema(REGISTRY).option("basePath", root).parquet(*folders).select(*REGISTRY.names)


def read_version(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    return _read(spark, root, _manifest(spark, root, batch_id)["written"])


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The registry after the newest finished batch; None before the first."""
    versions = _versions(spark, root)
    return read_version(spark, root, versions[0]) if versions else None


def advance(events: DataFrame, batch_id: int, root: str, cooldown: str = "last",
            keep: int = KEPT_VERSIONS, buckets: int = BUCKETS) -> list[int]:
    """Fold a batch of events into the buckets of the creators it names; gives these buckets.

    What a batch writes depends on the manifest before it and on the batch alone, so every replay gives the same. The
    cost is the size of the touched buckets. The number of buckets is that of the first batch. The last ``keep``
    versions can be read; a replay needs the one before its own.
    """
    if keep < 2:
        raise ValueError("a replay needs the version before: keep at least 2")
    spark, root = events.sparkSession, root.rstrip("/")
    earlier = [n for n in _versions(spark, root) if n < batch_id]
    before = _manifest(spark, root, earlier[0]) if earlier else {"buckets": buckets, "written": {}}
    buckets, written = before["buckets"], before["written"]
    events = as_registry_events(events)
    named = events.select(_bucket(event_username(), buckets).alias("bucket")).where(event_username().isNotNull())
    touched = sorted(r.bucket for r in named.distinct().collect())  # at most as many as buckets
    if touched:
        state = _read(spark, root, {b: n for b, n in written.items() if int(b) in set(touched)})
        folded = fold_registry(events, state, cooldown).withColumn("bucket", _bucket(F.col("username"), buckets))
        folded.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/batch={batch_id}")
        # Events about unknown creators leave no row, so a touched bucket may have stayed empty.
        made = child_names(spark, f"{root}/batch={batch_id}")
        written = written | {n.removeprefix("bucket="): batch_id for n in made if n.startswith("bucket=")}
    delete_folder(spark, f"{root}/{MANIFESTS}/{batch_id}")  # of the same batch before a replay
    write_text(spark, f"{root}/{MANIFESTS}/{batch_id}", json.dumps({"buckets": buckets, "written": written}))
    _tidy(spark, root, keep)
    return touched


def _tidy(spark: SparkSession, root: str, keep: int) -> None:
    """Delete manifests before the last ``keep`` and the bucket files that none of the kept ones names."""
    versions = _versions(spark, root)
    for old in versions[keep:]:
        delete_folder(spark, f"{root}/{MANIFESTS}/{old}")
    used = {_folder(b, n) for v in versions[:keep] for b, n in _manifest(spark, root, v)["written"].items()}
    for name in child_names(spark, root):
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= versions[0]:
            held = [b for b in child_names(spark, f"{root}/{name}") if b.startswith("bucket=")]
            gone = [b for b in held if f"{name}/{b}" not in used]
            for bucket in gone if len(gone) < len(held) else []:
                delete_folder(spark, f"{root}/{name}/{bucket}")
            if len(gone) == len(held):
                delete_folder(spark, f"{root}/{name}")


def start_registry(events: DataFrame, root: str, checkpoint: str, every: str | None = None,
                   cooldown: str = "last", keep: int = KEPT_VERSIONS, buckets: int = BUCKETS) -> StreamingQuery:
    """Fold a stream of registry events; events count in the order of ``seq`` within a batch, and of
    batches among each other, as the capture service applies them on arrival."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        advance(batch, batch_id, root, cooldown, keep, buckets)

    writer = as_registry_events(events).writeStream.foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()

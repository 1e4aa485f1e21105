"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # of checkpoints that nothing refers to any more
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(app: str = "roomtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` keys use __ for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master, where driver and executors share one
    disk. On a cluster the setting has to be there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="roomtide-")
    return _local_folders[context.applicationId]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)

"""Helpers the operators share: shipping the package, scratch folders, bounded memos, row streams."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from roomtide.runtime import shared_folder

ROWS_PER_BATCH = 1000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would.

    Also keeps Arrow batches at 1000 rows: whole texts in Spark's default of 10,000 rows would take hundreds of MB on
    either side of each Python worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="roomtide-ship-")) / "roomtide.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later plan reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: the lineage ends at shared files."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Memo(dict):
    """A function's results for at most 2 * ``limit`` keys; rarely used ones fall out by generation."""

    def __init__(self, make: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def column_rows(batches: Iterator, *names: str) -> Iterator[tuple]:
    """The named columns of Arrow batches as Python lists, a few hundred rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield tuple(part.column(part.schema.get_field_index(name)).to_pylist() for name in names)

"""Kafka as a streaming source (needs the spark-sql-kafka package on the cluster)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topics: list[str], group: str | None = None,
                  min_partitions: int | None = None, starting: str = "earliest") -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if group:
        options["groupIdPrefix"] = group
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_lines(spark: SparkSession, servers: str, topics: list[str], **kwargs) -> DataFrame:
    """The messages as text lines with their topic; offsets live in the query's checkpoint."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **kwargs)).load()
    return stream.select(F.col("value").cast("string").alias("value"), "topic")


def file_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of text files as a stream of lines, where there is no broker."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)

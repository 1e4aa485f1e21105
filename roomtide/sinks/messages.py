"""Envelopes as JSON messages: for Kafka, for the archive and for local files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.functions.timeparts import iso_utc

TOPIC_PREFIX = "live.events."

# Producer settings.
PRODUCER = {
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "65536",
    "kafka.request.timeout.ms": "30000",
    "kafka.retry.backoff.ms": "500",
}
HEAD = ("streamer", "category", "archetype", "event_type", "received_at")


def stamp(events: DataFrame) -> DataFrame:
    """Set the receive time of events that come without one."""
    return events.withColumn("received_at", iso_utc(F.current_timestamp()))


def message_text(columns: tuple[str, ...] = HEAD):
    """One JSON object on one line, payload nested and as it was, but for line breaks.

    In valid JSON line breaks stand between tokens only and become spaces. A payload that is not JSON goes in
    as a JSON string, so that the message stays readable.
    """
    head = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    boxed = F.to_json(F.array("data"))
    quoted = F.substring(boxed, F.lit(2), F.length(boxed) - 2)
    data = F.when(F.col("data").isNull(), "null").when(
        F.try_parse_json("data").isNotNull(), F.translate("data", "\r\n", "  ")
    ).otherwise(quoted)
    return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"data":'), data, F.lit("}"))


def to_messages(envelope: DataFrame, topic_prefix: str = TOPIC_PREFIX) -> DataFrame:
    """(topic, value): one topic per category, no key."""
    return envelope.select(
        F.concat(F.lit(topic_prefix), F.col("category")).alias("topic"), message_text().alias("value")
    )


def kafka_sink_options(servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **PRODUCER}


def write_kafka(messages: DataFrame, servers: str, checkpoint: str | None = None):
    """Send (topic, value) rows; a streaming DataFrame needs ``checkpoint`` and gives the query."""
    options = kafka_sink_options(servers)
    if messages.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming write needs a checkpoint folder")
        writer = messages.writeStream.format("kafka").options(**options)
        return writer.option("checkpointLocation", checkpoint).start()
    return messages.write.format("kafka").options(**options).save()


def append_jsonl(envelope: DataFrame, path: str) -> None:
    """Append envelopes to a folder of JSONL files, without category and archetype."""
    local = envelope.select(message_text(("streamer", "event_type", "received_at")).alias("value"))
    local.write.mode("append").text(path)

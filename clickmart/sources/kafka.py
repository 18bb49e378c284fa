"""Keyed messages from and to Kafka. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Delivery settings of the producer.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "32768",
    "kafka.compression.type": "gzip",
}


def read_messages(
    spark: SparkSession,
    servers: str,
    topics: Iterable[str],
    max_messages: int | None = None,
    min_messages: int | None = None,
    max_delay: str | None = None,
) -> DataFrame:
    """All topics as one stream from the earliest offset; at most ``max_messages`` a batch.

    With ``min_messages`` a batch waits until so many are there, but no longer than ``max_delay`` (as ``60s``): size or
    time, whichever comes first, given a trigger that looks often enough.
    """
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": max_messages, "minOffsetsPerTrigger": min_messages, "maxTriggerDelay": max_delay,
    }
    reader = spark.readStream.format("kafka")
    for key, value in options.items():
        if value:
            reader = reader.option(key, value)
    texts = [F.col(c).cast("string").alias(c) for c in ("key", "value")]
    return reader.load().select("topic", *texts)


def write_messages(messages: DataFrame, servers: str) -> None:
    """Send (topic, key, value) messages."""
    writer = messages.write.format("kafka").options(**PRODUCER_OPTIONS)
    writer.option("kafka.bootstrap.servers", servers).save()

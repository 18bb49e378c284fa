"""Event streams: decode, land, clean and count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmart import schemas
from clickmart.fixed_values import EVENT_KEYS, FLUSH_SECONDS, UNKNOWN_TYPE
from clickmart.functions.times import FIRST_MS, utc_time
from clickmart.operators.clean import add_event_time, drop_null_core, keep_valid_types, transform
from clickmart.operators.ingest import from_messages
from clickmart.operators.marts import funnel_daily, merged_sessions, session_parts
from clickmart.sources import manifest
from clickmart.sources.files import LANDING_PARTS, landing_parts, remove_batches

EVERY_FLUSH = {"processingTime": f"{FLUSH_SECONDS} seconds"}
DRAIN = {"availableNow": True}
#: Files that a batch has per type at most.
SPREAD = 2


decode = from_messages


def land_raw(
    messages: DataFrame, base: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Land messages (``topic``, ``key``, ``value``) verbatim, by type and hour of arrival, exactly once.

    The value is only decoded to find the folder, so broken texts, unknown keys and wrong types stay
    as they came, and the raw zone can be read again with another schema. Offsets are committed with
    the files, so a restart neither loses nor repeats messages.
    """
    arrival = utc_time(F.unix_millis(F.current_timestamp()))
    text = messages.select("topic", *(F.col(c).cast("string").alias(c) for c in ("key", "value")))
    kind = F.from_json("value", "event_type STRING")["event_type"]
    landed = text.select("*", *landing_parts(kind, arrival))
    writer = landed.writeStream.format("json").partitionBy(*LANDING_PARTS)
    writer = writer.option("path", base).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_FLUSH)).start()


def land_batches(
    messages: DataFrame, base: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Land messages verbatim like ``land_raw``, with a manifest by day instead of one growing log.

    A micro-batch arrives in one hour: its files go to ``day=/hour=/batch=<id>-<attempt>/et=``, and a marker in
    ``_manifest/<day>`` then names that folder. What has no marker is not there for readers, so files of
    broken attempts stay invisible; a batch that is run again after its marker was written is not written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if manifest.find(spark, base, batch_id):
            return
        text = batch.select("topic", *(F.col(c).cast("string").alias(c) for c in ("key", "value")))
        kind = F.coalesce(F.from_json("value", "event_type STRING")["event_type"], F.lit(UNKNOWN_TYPE))
        folder = manifest.new_folder(batch_id)
        path = f"{base.rstrip('/')}/{folder}"
        # Types are spread over tasks by message: most messages have the same one.
        part = F.pmod(F.xxhash64("key", "value"), F.lit(SPREAD))
        rows = text.withColumn("et", kind).repartition("et", part)
        rows.write.mode("overwrite").partitionBy("et").json(path)
        manifest.add(spark, base, folder)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_FLUSH)).start()


def missed(events: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Staging rows of raw events whose keys a streamed cleaning has not written: those the watermark dropped.

    Give it what landed over some days and what the stream wrote for the days these events belong to;
    ``daily.stage`` with ``merge`` brings the rows, as raw events, to exactly their days.
    """
    rows = transform(events)
    there = cleaned.select(*(F.col(c).alias(f"_{c}") for c in EVENT_KEYS))
    same = F.lit(True)
    for c in EVENT_KEYS:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return rows.join(there, same, "left_anti")


def _sound() -> Column:
    # A time ahead of the clock must not carry the watermark along.
    return F.col("ts").between(F.lit(FIRST_MS), F.unix_millis(F.current_timestamp()))


def clean(events: DataFrame, delay: str) -> DataFrame:
    """Streaming form of the batch cleaning, for ``start_batches`` in append mode.

    The first copy of an event to arrive stays; copies up to ``delay`` later in event time are removed,
    also across batches. Which one is first does not depend on a clock, and keys leave the state
    with the watermark. Events later than ``delay`` are dropped by it; they stay in the raw zone for
    the batch job, as do those of ``unsound``.
    """
    valid = keep_valid_types(drop_null_core(events)).filter(_sound())
    timed = valid.withColumn("instant", F.timestamp_millis("ts")).withWatermark("instant", delay)
    fresh = timed.dropDuplicatesWithinWatermark(list(EVENT_KEYS)).drop("instant")
    return add_event_time(fresh).select(*schemas.columns(schemas.STG))


def unsound(events: DataFrame) -> DataFrame:
    """Valid events that ``clean`` leaves out: their time is ahead of the clock or out of all range."""
    return keep_valid_types(drop_null_core(events)).filter(~_sound())


def type_counts(events: DataFrame) -> DataFrame:
    """Running totals per type, for complete mode."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def funnel(stg: DataFrame) -> DataFrame:
    """The daily funnel of a stream of staging rows, for complete mode; one row of state a day."""
    return funnel_daily(stg)


def start_sessions(
    stg: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """The session mart of a stream of staging rows, as partial rows per micro-batch.

    Begin, end and counts of a session merge, so the stream keeps no state, however long a session
    lasts or pauses; ``read_sessions`` merges them. A batch that is run again replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session_parts(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stg.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_FLUSH)).start()


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The session mart of all batches that ``start_sessions`` has written."""
    parts = spark.read.schema(schemas.MARTS["session"]).parquet(path)
    return merged_sessions(parts).select(*schemas.columns(schemas.MARTS["session"]))


def start_append(
    frame: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to Parquet files, each row exactly once."""
    writer = frame.writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_FLUSH)).start()


def start_batches(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partitions: Sequence[str] = schemas.STG_PARTITIONS,
    spread: int = 2,
) -> StreamingQuery:
    """Write every micro-batch of an append-mode ``frame`` to its own folder ``batch=<id>`` of ``path``.

    A batch is laid out like the staging table, with ``spread`` files per (day, type) at most, so
    ``read_stg`` reads ``path`` and prunes it. A batch that is run again replaces its folder: its rows
    count once. (Micro-batches run without adaptive execution, hence no rebalance here.)
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        part = F.pmod(F.xxhash64(*batch.columns), F.lit(spread))
        balanced = batch.repartition(*partitions, part)
        balanced.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/batch={batch_id}")

    writer = frame.writeStream.outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_FLUSH)).start()


def start_totals(
    frame: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the totals of a complete-mode ``frame`` after every micro-batch.

    A batch's totals get a folder of their own; when it is written, all but the one before it go, so
    a reader always finds whole totals and old ones do not pile up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Totals are a few rows.
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        remove_batches(batch.sparkSession, path, before=batch_id - 1)

    writer = frame.writeStream.outputMode("complete").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_FLUSH)).start()


def read_totals(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last totals that ``start_totals`` wrote."""
    rows = spark.read.schema(f"{schema}, batch BIGINT").parquet(path)
    last = rows.agg(F.max("batch")).first()[0]
    return rows.filter(F.col("batch") == last).select(*schemas.columns(schema))


def events_per_second(query: StreamingQuery) -> float | None:
    """Throughput of the last micro-batch."""
    progress = query.lastProgress
    return progress["processedRowsPerSecond"] if progress else None

"""Session log to event messages: unnest, normalise, assign users, enrich, encode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import LOG_TYPES, PROFILE_COLUMNS, PROFILE_SOURCES, UNKNOWN_TYPE
from clickmart.functions.hashing import hash_number
from clickmart.functions.times import hour_path
from clickmart.operators.joins import join_dimension
from clickmart.operators.limits import first_rows

INDEX_BUCKETS = 1024
CORRUPT = "_corrupt_record"


def topic_names(prefix: str = "shop") -> dict[str, str]:
    """Topic of each event type."""
    return {event_type: f"{prefix}.{log_type}" for log_type, event_type in LOG_TYPES.items()}


def explode_events(sessions: DataFrame) -> DataFrame:
    """One row per event of each session log line."""
    return sessions.select(F.col("session").alias("session_id"), F.inline("events"))


def _lookup(mapping: Mapping[str, str], key: Column) -> Column:
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def normalize_types(
    events: DataFrame, mapping: Mapping[str, str] = LOG_TYPES, strict: bool = False
) -> DataFrame:
    """Replace the log's ``type`` by ``event_type``.

    An unknown type becomes NULL, which the cleaning drops; in ``strict`` mode it fails the job.
    """
    known = _lookup(mapping, F.col("type"))
    if strict:
        message = F.concat(F.lit("unknown event type: "), F.coalesce("type", F.lit("NULL")))
        known = F.coalesce(known, F.raise_error(message).cast("string"))
    return events.withColumn("type", known).withColumnRenamed("type", "event_type")


def index_users(users: DataFrame, buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Number the users 0, 1, 2, ... without sorting them all in one task.

    Users are numbered within hash buckets; each bucket starts where the ones before it end. Only
    the bucket sizes, ``buckets`` rows at most, are put in one order.
    """
    ids = users.select("user_id", (hash_number(F.col("user_id")) % buckets).alias("bucket"))
    sizes = ids.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("bucket").orderBy("user_id"))
    return (
        ids.withColumn("position", within - 1)
        .join(F.broadcast(starts), "bucket")
        .select((F.col("start") + F.col("position")).alias("user_index"), "user_id")
    )


def assign_users(events: DataFrame, users: DataFrame, session: str = "session_id") -> DataFrame:
    """Give every session a user of the pool: always the same one, by hash of the session.

    Works on events and, cheaper, on session log lines before they are unnested. The pool is
    counted when the plan is built.
    """
    pool = users.count()
    if pool == 0:
        raise ValueError("the user pool is empty")
    drawn = events.withColumn("user_index", hash_number(F.col(session), 15) % pool)
    return join_dimension(drawn, index_users(users), "user_index").drop("user_index")


def build_events(
    sessions: DataFrame,
    users: DataFrame,
    mapping: Mapping[str, str] = LOG_TYPES,
    strict: bool = False,
) -> DataFrame:
    """Event records of a session log: users are assigned per log line, then events unnested."""
    lines = assign_users(sessions, users, session="session")
    events = lines.select(F.col("session").alias("session_id"), "user_id", F.inline("events"))
    return normalize_types(events, mapping, strict).select(*schemas.columns(schemas.EVENT))


def profiles(users: DataFrame) -> DataFrame:
    """The profile columns of the user dimension, named as on events."""
    named = (F.col(PROFILE_SOURCES.get(c, c)).alias(c) for c in PROFILE_COLUMNS)
    return users.select("user_id", *named)


def enrich(events: DataFrame, users: DataFrame) -> DataFrame:
    """Fill the profile columns of the events from the user dimension.

    The dimension wins, column by column; where it has no value (or no such user), the event keeps
    what it was delivered with.
    """
    named = {c: f"_{c}" for c in PROFILE_COLUMNS}
    joined = join_dimension(events, profiles(users).withColumnsRenamed(named), "user_id")
    filled = {c: F.coalesce(F.col(named[c]), F.col(c)) for c in PROFILE_COLUMNS}
    return joined.select(*(filled.get(c, F.col(c)).alias(c) for c in events.columns))


def to_messages(events: DataFrame, topics: Mapping[str, str] | None = None) -> DataFrame:
    """Events as keyed messages for the topic of their type; a type without topic has none.

    All columns of ``events`` go into the JSON value; text is kept as UTF-8.
    """
    return events.select(
        _lookup(topics or topic_names(), F.col("event_type")).alias("topic"),
        F.col("user_id").alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
    )


def from_messages(messages: DataFrame, schema: str = schemas.RAW, corrupt: bool = False) -> DataFrame:
    """Messages of all topics to events: topic, key and the fields of ``schema``.

    A field that cannot be read is NULL; with ``corrupt`` the value of such a message is kept whole
    in ``_corrupt_record``.
    """
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(
        F.col("value").cast("string"), f"{schema}, {CORRUPT} STRING" if corrupt else schema, options
    )
    named = messages.select("topic", F.col("key").cast("string").alias("key"), parsed.alias("event"))
    return named.select("topic", "key", "event.*")


def limit_events(frame: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``; 0 keeps all."""
    if n == 0:
        return frame
    return first_rows(frame, order, n)


def raw_path(event_type: Column, time: Column) -> Column:
    """Folder of an event in the raw zone: type, then year, month, day and hour."""
    return F.concat_ws("/", F.coalesce(event_type, F.lit(UNKNOWN_TYPE)), hour_path(time))

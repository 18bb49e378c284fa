"""Raw events to the staging table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import CORE_COLUMNS, EVENT_KEYS, EVENT_TYPES, PROFILE_COLUMNS
from clickmart.functions.times import utc_time


def drop_null_core(events: DataFrame, columns: Sequence[str] = CORE_COLUMNS) -> DataFrame:
    """Drop events that lack any of the core columns."""
    # One test per column, unlike dropna's count of values, is pushed into the scan.
    for column in columns:
        events = events.filter(F.col(column).isNotNull())
    return events


def keep_valid_types(events: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Keep events of the known types."""
    return events.filter(F.col("event_type").isin(*types))


def add_event_time(events: DataFrame) -> DataFrame:
    """Add ``event_dt`` (UTC, whole seconds) and ``event_date`` from the millisecond ``ts``."""
    return events.withColumn("event_dt", utc_time(F.col("ts"))).withColumn(
        "event_date", F.col("event_dt").cast("date")
    )


def dedup(events: DataFrame, keys: Sequence[str] = EVENT_KEYS) -> DataFrame:
    """One event per key; of differing copies the smallest (column by column) survives.

    The aggregate combines copies before the shuffle, so a key with very many copies sends one
    row per input partition. NULL keys count as equal, as in ``dropDuplicates``.
    """
    rest = [c for c in events.columns if c not in keys]
    if not rest:
        return events.select(*keys).distinct()
    survivor = events.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("rest"))
    return survivor.select(*keys, "rest.*").select(*events.columns)


def merge(stored: DataFrame, arrived: DataFrame, keys: Sequence[str] = EVENT_KEYS) -> DataFrame:
    """Rows of a staging table united with those that arrived later; each side has one row per key.

    The smaller user wins, as in ``dedup``. Of two rows of one user the stored one stays, and the arrived one fills the
    profile columns it has no value in: rows that arrive again, without the profiles that the stored ones were given,
    change nothing.
    """
    rest = [c for c in stored.columns if c not in (*keys, "user_id")]
    sides = [rows.withColumn("_side", F.lit(i)) for i, rows in enumerate((stored, arrived))]
    row = F.struct("user_id", "_side", *rest)
    # Two rows per key at most: the smallest is the survivor, the largest the other one.
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.min(row).alias("one"), F.max(row).alias("two"))
    same = F.col("one.user_id") == F.col("two.user_id")

    def value(column: str) -> Column:
        chosen = F.col(f"one.{column}")
        if column in PROFILE_COLUMNS:
            chosen = F.coalesce(chosen, F.when(same, F.col(f"two.{column}")))
        return chosen.alias(column)

    return both.select(*keys, value("user_id"), *map(value, rest)).select(*stored.columns)


def transform(raw: DataFrame) -> DataFrame:
    """Raw events to staging rows: complete, of a known type, one per key, with event times.

    Only raw columns go through the shuffle; the times are derived from ``ts`` after it. The
    type filter uses a key column, so filtering before the dedup gives the same rows.
    """
    events = dedup(keep_valid_types(drop_null_core(raw)))
    return add_event_time(events).select(*schemas.columns(schemas.STG))

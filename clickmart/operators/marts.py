"""Business marts over the staging table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import EVENT_TYPES
from clickmart.functions.rates import rate
from clickmart.functions.times import month, seconds_between


def type_counts() -> list[Column]:
    """Number of events of each type, as ``<type>_count``."""
    return [F.count_if(F.col("event_type") == t).alias(f"{t}_count") for t in EVENT_TYPES]


def funnel_daily(stg: DataFrame) -> DataFrame:
    """Events per day and type, and the conversion between types in percent.

    Reads nothing but the partition columns of the staging table.
    """
    days = stg.groupBy(F.col("event_date").alias("dt")).agg(*type_counts())
    return days.select(
        "*",
        rate("cart_count", "click_count").alias("click_to_cart"),
        rate("order_count", "cart_count").alias("cart_to_order"),
        rate("order_count", "click_count").alias("click_to_order"),
    )


SESSION_KEY = ("session_id", "user_id", "platform", "region")


def session_parts(stg: DataFrame) -> DataFrame:
    """Begin, end and event counts per session key; parts of a session can be merged."""
    return stg.groupBy(*SESSION_KEY).agg(
        F.min("event_dt").alias("session_start"),
        F.max("event_dt").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"),
        *type_counts(),
    )


def merged_sessions(parts: DataFrame) -> DataFrame:
    """Sessions from parts of them."""
    counts = ("event_count", *(f"{t}_count" for t in EVENT_TYPES))
    return _timed(parts.groupBy(*SESSION_KEY).agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        *(F.sum(c).alias(c) for c in counts),
    ))


def _timed(sessions: DataFrame) -> DataFrame:
    duration = seconds_between(F.col("session_start"), F.col("session_end"))
    return sessions.withColumn("duration_sec", duration)


def session(stg: DataFrame) -> DataFrame:
    """Begin, end, duration and event counts of every session."""
    return _timed(session_parts(stg))


def first_month(stg: DataFrame) -> DataFrame:
    """Month of each user's first activity."""
    first = stg.groupBy("user_id").agg(F.min("event_date").alias("first"))
    return first.select("user_id", month(F.col("first")).alias("cohort_month"))


def activity_months(stg: DataFrame) -> DataFrame:
    """The months in which each user was active."""
    # Months are grouped as dates (4 bytes) and become text afterwards.
    active = stg.select("user_id", F.trunc("event_date", "month").alias("activity")).distinct()
    return active.select("user_id", month(F.col("activity")).alias("activity_month"))


def cohort_size(first: DataFrame) -> DataFrame:
    """Users per month of first activity."""
    return first.groupBy("cohort_month").agg(F.count("user_id").alias("cohort_size"))


def _active(stg: DataFrame) -> DataFrame:
    # Months are combined before the shuffle, by hash; what is left, a row per user and calendar
    # month at most, is what the window of the cohorts sorts.
    known = stg.filter(F.col("user_id").isNotNull())
    return known.select("user_id", F.trunc("event_date", "month").alias("activity")).distinct()


def _cohort_activity(active: DataFrame) -> DataFrame:
    # A user's first month is the smallest of the active ones, so the staging table is read once.
    cohort = F.min("activity").over(Window.partitionBy("user_id"))
    return active.select("user_id", cohort.alias("cohort"), "activity").filter("activity IS NOT NULL")


def cohort_activity(stg: DataFrame) -> DataFrame:
    """Active months of each user next to the month of first activity."""
    return _cohort_activity(_active(stg)).select(
        "user_id",
        month(F.col("activity")).alias("activity_month"),
        month(F.col("cohort")).alias("cohort_month"),
    )


def cohort(stg: DataFrame) -> DataFrame:
    """Retention: how many users of each cohort were active in each month."""
    return cohort_of_months(_active(stg))


def cohort_of_months(active: DataFrame) -> DataFrame:
    """Retention from one row per user and month of activity (``user_id``, ``activity``).

    Every user is active in the cohort's own month, so that cell is the size of the cohort.
    """
    cells = _cohort_activity(active).groupBy("cohort", "activity")
    cells = cells.agg(F.count(F.lit(1)).alias("active_users"))
    own = F.when(F.col("activity") == F.col("cohort"), F.col("active_users"))
    sized = cells.withColumn("cohort_size", F.max(own).over(Window.partitionBy("cohort")))
    return sized.select(
        month(F.col("cohort")).alias("cohort_month"),
        month(F.col("activity")).alias("activity_month"),
        "active_users",
        "cohort_size",
        rate("active_users", "cohort_size").alias("retention_rate"),
    )


def item_stats(stg: DataFrame) -> DataFrame:
    """Events per item and type, and carts and orders in percent of clicks."""
    return item_rates(stg.groupBy("aid").agg(*type_counts()))


def item_rates(items: DataFrame) -> DataFrame:
    """Carts and orders in percent of clicks, beside the counts of each item."""
    return items.select(
        "*",
        rate("cart_count", "click_count").alias("cart_rate"),
        rate("order_count", "click_count").alias("order_rate"),
    )


BUILDERS = {
    "funnel_daily": funnel_daily,
    "session": session,
    "cohort": cohort,
    "item_stats": item_stats,
}


def build(stg: DataFrame, name: str) -> DataFrame:
    """A mart by name, in the column order of its table."""
    return BUILDERS[name](stg).select(*schemas.columns(schemas.MARTS[name]))

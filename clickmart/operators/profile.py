"""Samples, frequencies and display forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.fixed_values import DISPLAY_ZONE
from clickmart.functions.rates import rate
from clickmart.functions.times import in_zone


def sample(frame: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in ``order``."""
    return frame.orderBy(*order).limit(n)


def type_stats(events: DataFrame) -> DataFrame:
    """Events per type, in the order of the types."""
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("event_type")


def value_shares(
    users: DataFrame,
    dimensions: Sequence[str],
    display_orders: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Users per value of each dimension, their share in percent and the place in the listing.

    All dimensions are counted in one pass. Values are listed by frequency, or as in
    ``display_orders`` where that has the dimension.
    """
    values = users.select(*dimensions).unpivot([], list(dimensions), "dimension", "value")
    counts = values.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    listed = F.lit(0)
    for name, order in (display_orders or {}).items():
        place = F.array_position(F.array(*map(F.lit, order)), F.col("value"))
        listed = F.when(F.col("dimension") == name, place).otherwise(listed)
    by_dimension = Window.partitionBy("dimension")
    listing = by_dimension.orderBy(listed, F.desc("n"), "value")
    return counts.select(
        "dimension",
        "value",
        "n",
        rate(F.col("n"), F.sum("n").over(by_dimension), 1).alias("share"),
        F.row_number().over(listing).cast("bigint").alias("place"),
    )


def top_k(frame: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values; of equally frequent ones the smaller comes first."""
    counts = frame.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(k)


def to_display_zone(events: DataFrame, zone: str = DISPLAY_ZONE) -> DataFrame:
    """Add ``display_dt``, the event time on the clocks of ``zone``."""
    return events.withColumn("display_dt", in_zone(F.col("event_dt"), zone))

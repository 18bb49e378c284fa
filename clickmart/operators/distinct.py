"""Exact distinct counts that can be stored and merged: bitmaps over a dense index, by the built-in bitmap aggregates.

Ids are numbered 1, 2, 3, ...; a bitmap holds the numbers of one bucket (32,768 of them, 4 KB). Bitmaps per group, such
as a day, are stored; those of longer groups are their union, and counts over them need neither ids nor events again.
Repeated ids count once however often they are merged, and a group that changes replaces its own bitmaps only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions.hashing import hash_number
from clickmart.functions.rates import rate
from clickmart.functions.times import month

BUCKETS = 1024


def index(ids: DataFrame, id: str, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Each distinct id with its number ``n``; ids of ``known`` (a written index) keep theirs, new ones follow.

    Ids are numbered within hash buckets, and each bucket starts where those before it end, so no task sorts all of
    them. The largest number known is read when the plan is built. Missing ids have no number.
    """
    fresh = ids.select(id).filter(F.col(id).isNotNull()).distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known, id, "left_anti")
        first = known.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    dealt = fresh.select(id, (hash_number(F.col(id).cast("string")) % buckets).alias("bucket"))
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(id))
    numbered = dealt.withColumn("place", place).join(F.broadcast(starts), "bucket")
    numbered = numbered.select(id, (F.col("start") + F.col("place") + F.lit(first)).alias("n"))
    return numbered if known is None else known.select(id, "n").unionByName(numbered)


def bitmaps(rows: DataFrame, id: str, numbers: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """``bits`` of the ids of each group and ``bucket``; an id is sent once per group, whatever its rows."""
    groups = [F.col(c) if isinstance(c, str) else c for c in by]
    once = rows.filter(F.col(id).isNotNull()).select(*groups, id).distinct()
    names = [c for c in once.columns if c != id]
    found = once.join(numbers, id).groupBy(*names, F.bitmap_bucket_number("n").alias("bucket"))
    return found.agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))


def merged(bits: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The union of stored bitmaps by longer groups."""
    groups = [F.col(c) if isinstance(c, str) else c for c in by]
    return bits.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count(bits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids ``n`` per group of bitmaps that have one row per group and bucket."""
    return bits.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def _up_to(bits: DataFrame) -> DataFrame:
    """Users active in each ``month`` or before, for every month of all (buckets without one carry on)."""
    # At most one per calendar month; a bucket without a month gets an empty row for it.
    months = F.array(*(F.lit(r[0]) for r in bits.select("month").distinct().collect())).cast("array<date>")
    grid = bits.select("bucket").distinct().select("bucket", F.explode(months).alias("month"))
    whole = grid.join(bits, ["month", "bucket"], "left")
    so_far = Window.partitionBy("bucket").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return whole.select("month", "bucket", F.bitmap_or_agg("bits").over(so_far).alias("bits"))


def cohort_size(bits: DataFrame) -> DataFrame:
    """Users per month of first activity from bitmaps by ``month`` (a date): how many more there are up to it."""
    so_far = count(_up_to(bits), ["month"])
    # One row per month.
    before = F.coalesce(F.lag("n").over(Window.orderBy("month")), F.lit(0))
    sizes = so_far.select("month", (F.col("n") - before).alias("cohort_size")).filter("cohort_size > 0")
    return sizes.select(month(F.col("month")).alias("cohort_month"), "cohort_size")


def cohort(bits: DataFrame) -> DataFrame:
    """Retention from bitmaps by ``month``, without a look at users.

    Users of cohort c active in month a are those active up to c, less those up to the month before, that a has too; the
    size of an intersection follows from that of the union. Each bucket makes a row per pair of months: for very many
    months times users, ``marts.cohort_of_months`` moves less.
    """
    so_far = _up_to(bits).withColumnRenamed("month", "cohort").withColumnRenamed("bits", "early")
    active = bits.select("bucket", F.col("month").alias("activity"), F.col("bits").alias("late"))
    pairs = so_far.join(active, "bucket").filter("cohort <= activity")
    both = pairs.select("cohort", "activity", "bucket", F.explode(F.array("early", "late")).alias("bits"))
    union = merged(both, ["cohort", "activity"]).withColumn("n", F.bitmap_count("bits"))
    sizes = pairs.select(
        "cohort", "activity", "bucket", (F.bitmap_count("early") + F.bitmap_count("late")).alias("sizes")
    )
    shared = union.join(sizes, ["cohort", "activity", "bucket"])
    shared = shared.groupBy("cohort", "activity").agg(F.sum(F.col("sizes") - F.col("n")).alias("shared"))
    before = F.lag("shared").over(Window.partitionBy("activity").orderBy("cohort"))
    cells = shared.withColumn("active_users", F.col("shared") - F.coalesce(before, F.lit(0)))
    own = F.when(F.col("activity") == F.col("cohort"), F.col("active_users"))
    sized = cells.withColumn("cohort_size", F.max(own).over(Window.partitionBy("cohort")))
    return sized.filter("active_users > 0").select(
        month(F.col("cohort")).alias("cohort_month"),
        month(F.col("activity")).alias("activity_month"),
        "active_users",
        "cohort_size",
        rate("active_users", "cohort_size").alias("retention_rate"),
    )

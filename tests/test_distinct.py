from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickmart.operators import distinct, marts
from clickmart.sources import files


def numbered(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id string")


def test_numbers_are_dense_and_lasting(spark):
    first = files.scratch_table(spark, distinct.index(numbered(spark, ["a", "b", None, "b", "c"]), "user_id"), "index")
    assert sorted(r.n for r in first.collect()) == [1, 2, 3]
    both = distinct.index(numbered(spark, ["d", "a", None, "e", "d"]), "user_id", first)
    rows = {r.user_id: r.n for r in both.collect()}
    assert sorted(rows.values()) == [1, 2, 3, 4, 5] and {r.user_id: r.n for r in first.collect()}.items() <= rows.items()
    assert distinct.index(numbered(spark, []), "user_id").collect() == []


@pytest.mark.parametrize("users", [40, 40_000])
def test_merged_bitmaps_count_like_distinct(spark, users):
    """More users than a bucket holds; days that are stored are merged to months without looking at users again."""
    rng = random.Random(users)
    rows = [(f"u{rng.randrange(users)}", f"2024-{rng.randint(1, 5):02}-{rng.randint(1, 28):02}") for _ in range(2 * users)]
    rows += [(None, "2024-01-01"), ("late", "2024-05-01"), ("late", "2024-05-01")]
    events = spark.createDataFrame(rows, "user_id string, d string").select("user_id", F.to_date("d").alias("event_date"))
    numbers = files.scratch_table(spark, distinct.index(events, "user_id"), "index")
    days = files.scratch_table(spark, distinct.bitmaps(events, "user_id", numbers, ["event_date"]), "bits")
    months = distinct.merged(days, [F.trunc("event_date", "month").alias("month")])
    want = {r[0]: r[1] for r in events.groupBy(F.trunc("event_date", "month")).agg(F.count_distinct("user_id")).collect()}
    assert {r.month: r.n for r in distinct.count(months, ["month"]).collect()} == want
    assert set(distinct.cohort(months).collect()) == set(marts.cohort(events).collect())
    sizes = marts.cohort_size(marts.first_month(events.filter("user_id IS NOT NULL")))
    assert set(distinct.cohort_size(months).collect()) == set(sizes.collect())
    assert distinct.count(distinct.merged(days, [])).first().n == len({u for u, _ in rows if u})


def test_a_day_that_changes_replaces_its_own_bitmaps(spark):
    rows = [("a", 1), ("b", 1), ("a", 2)]
    numbers = files.scratch_table(spark, distinct.index(numbered(spark, "abc"), "user_id"), "index")
    old = distinct.bitmaps(spark.createDataFrame(rows, "user_id string, day int"), "user_id", numbers, ["day"])
    fresh = distinct.bitmaps(spark.createDataFrame([("c", 1)], "user_id string, day int"), "user_id", numbers, ["day"])
    both = old.filter("day <> 1").unionByName(fresh)
    assert {r.day: r.n for r in distinct.count(both, ["day"]).collect()} == {1: 1, 2: 1}
    assert distinct.count(distinct.merged(both, [])).first().n == 2


def test_no_rows_count_as_none(spark):
    numbers = distinct.index(numbered(spark, []), "user_id")
    empty = distinct.bitmaps(numbered(spark, []).withColumn("day", F.lit(1)), "user_id", numbers, ["day"])
    assert distinct.count(empty).first().n == 0 and distinct.count(empty, ["day"]).collect() == []

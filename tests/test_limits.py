from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickmart.operators.limits import _not_behind, first_rows

ORDER = ("a", "b", "t")


def table(spark, rows):
    return spark.createDataFrame(rows, "a BIGINT, b BIGINT, t STRING")


def smallest(rows, n):
    def key(row):
        return [(v is not None, v if v is not None else 0) for v in row[:2]] + [
            (row[2] is not None, row[2] or "")
        ]
    return Counter(sorted(rows, key=key)[:n])


numbers = st.one_of(
    st.none(), st.integers(-3, 3), st.sampled_from([-(2**63), 2**63 - 1, 10**12, 77])
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(numbers, numbers, st.sampled_from([None, "x", "y"])), min_size=1, max_size=40),
    st.integers(1, 45),
    st.sampled_from([2, 3, 1000]),
)
def test_first_rows_are_the_smallest(spark, rows, n, steps):
    got = first_rows(table(spark, rows), ORDER, n, steps).collect()
    assert Counter(tuple(r) for r in got) == smallest(rows, n)


@pytest.mark.parametrize("steps", [10, 1000])
def test_a_hot_value_is_cut_by_the_next_column(spark, steps):
    rows = [(7, i, "x") for i in range(5000)] + [(i, 0, "y") for i in range(5)]
    frame = table(spark, rows).repartition(4).cache()
    got = first_rows(frame, ORDER, 100, steps).collect()
    assert Counter(tuple(r) for r in got) == smallest(rows, 100)
    assert frame.filter(_not_behind(frame, ORDER, 100, steps)).count() <= 300
    frame.unpersist()


def test_little_more_than_the_limit_reaches_the_sort(spark):
    frame = spark.range(100_000).selectExpr("id * 1000003 % 99991 AS a")
    assert 50 <= frame.filter(_not_behind(frame, ["a"], 50, 100)).count() <= 150


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_texts_and_times_are_cut_off_before_the_sort(spark, kind):
    when = F.timestamp_seconds(F.col("id") * 7919 % 5000 * 28_800)
    value = {"string": F.concat(F.lit("k"), (F.col("id") * 7919 % 5000).cast("string"), F.lit("é")), "date": when.cast("date")}
    frame = spark.range(5000).select(F.when(F.col("id") % 501 != 0, value.get(kind, when.cast(kind))).alias("k"), "id")
    want = [r.id for r in frame.orderBy("k", "id").limit(120).collect()]
    kept = frame.filter(_not_behind(frame, ["k", "id"], 120, 50))
    assert 120 <= kept.count() < 1500
    assert [r.id for r in first_rows(frame, ["k", "id"], 120, 50).collect()] == want


def test_texts_that_begin_alike_are_all_kept(spark):
    frame = spark.createDataFrame([(f"same beginning {i:03}", i) for i in range(300)], "k string, id long")
    assert [r.id for r in first_rows(frame, ["k"], 5).collect()] == [0, 1, 2, 3, 4]

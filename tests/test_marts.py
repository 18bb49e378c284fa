from __future__ import annotations

from collections import defaultdict
from datetime import datetime

from pyspark.sql import functions as F
from test_clean import raw

from clickmart.functions.rates import rate
from clickmart.operators import clean, ingest, marts, profile
from clickmart.plans import fixtures

DAY = 86_400_000


def stg(spark, *rows):
    return clean.add_event_time(raw(spark, *rows))


def test_rates_round_half_up_and_are_null_over_zero(spark):
    pairs = [(1, 3), (1, 8), (1, 800), (5, 0), (0, 0), (0, 4), (3, 2), (None, 1), (1, None)]
    frame = spark.createDataFrame(pairs, "a BIGINT, b BIGINT").withColumn("r", rate("a", "b"))
    expected = [33.33, 12.5, 0.13, None, None, 0.0, 150.0, None, None]
    assert [row.r for row in frame.collect()] == expected


def test_funnel_counts_events_not_users(spark):
    rows = [(1, 1, i, "click", "u") for i in range(3)] + [(1, 1, 9, "cart", "u")]
    rows += [(1, 1, DAY, "order", "u"), (1, 1, DAY, "weird", "u"), (1, 1, DAY, None, "u")]
    got = [tuple(r)[1:] for r in marts.funnel_daily(stg(spark, *rows)).orderBy("dt").collect()]
    assert got == [(3, 1, 0, 33.33, 0.0, 0.0), (0, 0, 1, None, None, None)]


def test_session_spans_its_events(spark):
    rows = [(1, 1, 1500, "click", "u"), (1, 2, 62_100, "order", "u"), (2, 1, 5, "cart", "v")]
    got = {r.session_id: r for r in marts.session(stg(spark, *rows)).collect()}
    assert got[1].session_start == datetime(1970, 1, 1, 0, 0, 1)
    assert got[1].session_end == datetime(1970, 1, 1, 0, 1, 2)
    assert (got[1].duration_sec, got[1].event_count) == (61, 2)
    assert (got[1].click_count, got[1].cart_count, got[1].order_count) == (1, 0, 1)
    assert (got[2].duration_sec, got[2].platform) == (0, None)


def test_a_session_with_two_users_gives_two_rows(spark):
    rows = [(1, 1, 1, "click", "u"), (1, 1, 2, "click", "v")]
    assert marts.session(stg(spark, *rows)).count() == 2


def test_item_rates_are_over_clicks(spark):
    rows = [(1, 7, i, "click", "u") for i in range(4)]
    rows += [(1, 7, 10, "cart", "u"), (1, 7, 11, "order", "u"), (1, 8, 1, "order", "u")]
    got = {r.aid: tuple(r)[1:] for r in marts.item_stats(stg(spark, *rows)).collect()}
    assert got == {7: (4, 1, 1, 25.0, 25.0), 8: (0, 0, 1, None, None)}


def test_cohort_against_brute_force(spark, sf_dir):
    events = fixtures.cohort_events(spark, sf_dir)
    months = defaultdict(set)
    for row in events.select("user_id", "event_date").collect():
        months[row.user_id].add(row.event_date.strftime("%Y-%m"))
    cells, sizes = defaultdict(int), defaultdict(int)
    for active in months.values():
        sizes[min(active)] += 1
        for month in active:
            cells[min(active), month] += 1
    got = {
        (r.cohort_month, r.activity_month): (r.active_users, r.cohort_size)
        for r in marts.cohort(events).collect()
    }
    assert got == {cell: (n, sizes[cell[0]]) for cell, n in cells.items()}


def test_cohort_leaves_out_events_without_user(spark):
    rows = [(1, 1, 1, "click", None), (1, 1, 40 * DAY, "click", "u"), (2, 1, 80 * DAY, "cart", "u")]
    got = [tuple(r) for r in marts.cohort(stg(spark, *rows)).orderBy("activity_month").collect()]
    assert got == [("1970-02", "1970-02", 1, 1, 100.0), ("1970-02", "1970-03", 1, 1, 100.0)]


def test_marts_account_for_every_staging_row(spark, sf_dir):
    rows = fixtures.stg(spark, sf_dir).cache()
    total = rows.count()
    counts = F.sum(F.col("click_count") + F.col("cart_count") + F.col("order_count"))
    for mart in (marts.funnel_daily, marts.session, marts.item_stats):
        assert mart(rows).agg(counts).first()[0] == total
    assert marts.session(rows).agg(F.sum("event_count")).first()[0] == total
    cohort = marts.cohort(rows)
    own = cohort.filter("cohort_month = activity_month")
    assert own.filter("retention_rate <> 100").isEmpty()
    assert own.agg(F.sum("cohort_size")).first()[0] == rows.select("user_id").distinct().count()
    rows.unpersist()


def test_steps_of_the_cohort_agree_with_each_other(spark, sf_dir):
    events = fixtures.cohort_events(spark, sf_dir)
    joined = marts.activity_months(events).join(marts.first_month(events), "user_id")
    together = marts.cohort_activity(events).select(*joined.columns)
    assert joined.exceptAll(together).isEmpty() and together.exceptAll(joined).isEmpty()


def test_shares_and_listing_places(spark):
    users = spark.createDataFrame(
        [("F", "b"), ("M", "a"), ("M", "a"), ("M", "c"), ("M", None)], "gender STRING, tier STRING"
    )
    listed = profile.value_shares(users, ("gender", "tier"), {"tier": ["c", "b", "a"]})
    got = {(r.dimension, r.value): (r.n, r.share, r.place) for r in listed.collect()}
    assert got["gender", "M"] == (4, 80.0, 1) and got["gender", "F"] == (1, 20.0, 2)
    assert [got["tier", v][2] for v in ("c", "b", "a")] == [2, 3, 4]
    assert got["tier", None] == (1, 20.0, 1)


def test_top_k_breaks_ties_by_value(spark):
    frame = spark.createDataFrame([(v,) for v in "bbaacd"], "v STRING")
    assert [tuple(r) for r in profile.top_k(frame, "v", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_limit_takes_the_first_in_order_and_zero_all(spark):
    frame = spark.range(100).repartition(7).withColumnRenamed("id", "session_id")
    assert [r[0] for r in ingest.limit_events(frame, ["session_id"], 3).collect()] == [0, 1, 2]
    assert ingest.limit_events(frame, ["session_id"], 0).count() == 100

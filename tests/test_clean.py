from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.operators import clean, marts, quality
from clickmart.plans import fixtures


def raw(spark, *rows):
    """Raw events given as (session, item, ts, type, user)."""
    frame = spark.createDataFrame(list(rows), schemas.EVENT)
    missing = [F.lit(None).cast("string").alias(c) for c in ("gender", "age_group")]
    extra = [F.lit(None).cast("string").alias(c) for c in ("region", "membership", "platform")]
    return frame.select("*", *missing, *extra)


def test_every_core_column_is_mandatory(spark):
    good = (1, 2, 3, "click", "u")
    holes = [tuple(None if i == hole else v for i, v in enumerate(good)) for hole in range(5)]
    kept = clean.drop_null_core(raw(spark, good, *holes)).collect()
    assert [tuple(row)[:5] for row in kept] == [good]


def test_only_known_types_stay(spark):
    rows = [(1, 1, 1, kind, "u") for kind in ("click", "cart", "order", "clicks", "CLICK", None)]
    kept = clean.keep_valid_types(raw(spark, *rows))
    assert sorted(row.event_type for row in kept.collect()) == ["cart", "click", "order"]


@pytest.mark.parametrize(
    ("ms", "time", "day"),
    [
        (0, datetime(1970, 1, 1), date(1970, 1, 1)),
        (1999, datetime(1970, 1, 1, 0, 0, 1), date(1970, 1, 1)),
        (-1500, datetime(1969, 12, 31, 23, 59, 59), date(1969, 12, 31)),
        (-999, datetime(1970, 1, 1), date(1970, 1, 1)),
        (1709251199999, datetime(2024, 2, 29, 23, 59, 59), date(2024, 2, 29)),
        (253402300799999, datetime(9999, 12, 31, 23, 59, 59), date(9999, 12, 31)),
        (253402300800000, None, None),
        (2**63 - 1, None, None),
        (-(2**63), None, None),
        (None, None, None),
    ],
)
def test_times_are_cut_toward_zero_and_never_overflow(spark, ms, time, day):
    row = clean.add_event_time(raw(spark, (1, 1, ms, "click", "u"))).first()
    assert (row.event_dt, row.event_date) == (time, day)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Seoul", "Pacific/Apia"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    # 2018-11-04 00:30 does not exist in Sao Paulo, 2011-12-30 not in Apia.
    instants = [1541291400000, 1325203200000 + 86_400_000, 1706745599000]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stg = clean.transform(raw(spark, *((i, 1, ts, "click", "u") for i, ts in enumerate(instants))))
        times = {row.session_id: str(row.t) for row in stg.select(
            "session_id", F.col("event_dt").cast("string").alias("t")).collect()}
        months = {(r.cohort_month, r.activity_month) for r in marts.cohort(stg).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert times == {0: "2018-11-04 00:30:00", 1: "2011-12-31 00:00:00", 2: "2024-01-31 23:59:59"}
    assert months == {("2011-12", "2011-12"), ("2011-12", "2018-11"), ("2011-12", "2024-01")}


def test_smallest_copy_survives_whatever_the_partitioning(spark):
    rows = [(1, 1, 1, "click", user) for user in ("u9", "u10", "u2")] + [(1, 1, 2, "click", "z")]
    for parts in (1, 4):
        survivors = clean.dedup(raw(spark, *rows).repartition(parts)).collect()
        assert sorted((r.ts, r.user_id) for r in survivors) == [(1, "u10"), (2, "z")]


def test_null_keys_are_copies_of_each_other(spark):
    rows = [(1, None, 1, "click", "u")] * 3 + [(1, 0, 1, "click", "u")]
    assert clean.dedup(raw(spark, *rows)).count() == 2


def test_dedup_without_other_columns(spark):
    rows = raw(spark, (1, 1, 1, "click", "u"), (1, 1, 1, "click", "v"))
    assert clean.dedup(rows.select("session_id", "aid", "ts", "event_type")).count() == 1


def test_transform_is_idempotent_and_passes_the_checks(spark, sf_dir):
    stg = fixtures.stg(spark, sf_dir)
    assert stg.columns == schemas.columns(schemas.STG)
    again = clean.transform(stg.select(*schemas.columns(schemas.RAW)))
    assert stg.exceptAll(again).isEmpty() and again.exceptAll(stg).isEmpty()
    assert quality.run_checks(stg).filter("not passed").isEmpty()

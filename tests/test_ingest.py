from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_clean import raw

from clickmart import schemas
from clickmart.functions.times import utc_time
from clickmart.operators import ingest, joins
from clickmart.plans import fixtures


def log(spark, *sessions):
    return spark.createDataFrame(list(sessions), schemas.SESSION_LOG)


def pool(spark, n):
    ids = spark.range(n).select(F.concat(F.lit("u"), "id").alias("user_id"))
    others = [c for c in schemas.columns(schemas.USERS) if c != "user_id"]
    return ids.select("user_id", *(F.concat(F.lit(c), "user_id").alias(c) for c in others))


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_sessions_without_events_give_none(spark):
    lines = log(spark, (1, [(5, 1, "clicks"), (6, 2, "carts")]), (2, []), (3, None))
    got = [tuple(r) for r in ingest.explode_events(lines).orderBy("ts").collect()]
    assert got == [(1, 5, 1, "clicks"), (1, 6, 2, "carts")]


def test_unknown_types_become_null_or_fail(spark):
    events = ingest.explode_events(log(spark, (1, [(5, 1, "clicks"), (6, 2, "views"), (7, 3, None)])))
    got = ingest.normalize_types(events).orderBy("ts").collect()
    assert [r.event_type for r in got] == ["click", None, None]
    with pytest.raises(Exception, match="unknown event type: views"):
        ingest.normalize_types(events.filter("ts = 2"), strict=True).collect()


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_users_are_numbered_without_gaps(spark, buckets):
    indexed = ingest.index_users(pool(spark, 500), buckets).collect()
    assert sorted(r.user_index for r in indexed) == list(range(500))
    assert len({r.user_id for r in indexed}) == 500


def test_numbering_does_not_depend_on_the_partitioning(spark):
    users = pool(spark, 300)
    numbered = ingest.index_users(users)
    assert same(numbered, ingest.index_users(users.repartition(13)))


def test_a_session_keeps_its_user_over_lines_and_runs(spark):
    users = pool(spark, 40)
    lines = log(spark, *[(s, [(i, i, "clicks")]) for s in range(200) for i in (1, 2)])
    first = ingest.build_events(lines, users)
    again = ingest.build_events(lines.repartition(5), users.repartition(3))
    assert first.columns == schemas.columns(schemas.EVENT)
    assert same(first, again)
    owners = first.groupBy("session_id").agg(F.count_distinct("user_id").alias("n"))
    assert owners.filter("n <> 1").isEmpty() and owners.count() == 200


def test_sessions_spread_over_all_users(spark):
    events = spark.range(20_000).withColumnRenamed("id", "session_id")
    users = ingest.assign_users(events, pool(spark, 20)).groupBy("user_id").count().collect()
    assert len(users) == 20 and all(800 < r["count"] < 1200 for r in users)


def test_an_empty_pool_is_refused(spark):
    with pytest.raises(ValueError, match="empty"):
        ingest.assign_users(spark.range(1).withColumnRenamed("id", "session_id"), pool(spark, 0))


def test_a_shuffled_join_gives_the_rows_of_a_broadcast_join(spark):
    # A third of the facts has one key, and there are more than a thousand other frequent keys.
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "u7").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("u"), F.col("id") % 1500)).alias("user_id"),
        F.col("id").alias("n"),
    )
    users = pool(spark, 1400).select("user_id", "region")
    small = joins.join_dimension(facts, users, "user_id").cache()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.join_dimension(facts, users, "user_id", salts=16)
        assert large.columns == small.columns and same(large, small) and large.count() == 30_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        small.unpersist()


def test_facts_without_a_key_are_spread(spark):
    facts = spark.range(8000).select(F.lit(None).cast("string").alias("user_id"), "id")
    users = pool(spark, 10).select("user_id", "region")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.join_dimension(facts, users, "user_id", salts=64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2000
    assert sum(r["count"] for r in sizes) == 8000


def test_enrich_fills_the_profile_and_keeps_what_was_delivered(spark):
    events = raw(spark, (1, 1, 1, "click", "u3"), (1, 1, 2, "cart", "nobody"), (1, 1, 3, "cart", None))
    events = events.withColumn("region", F.lit("delivered"))
    got = ingest.enrich(events, pool(spark, 5))
    assert got.columns == events.columns
    rows = {r.ts: r for r in got.collect()}
    assert rows[1].platform == "preferred_deviceu3" and rows[1].gender == "genderu3"
    assert rows[1].region == "regionu3"
    assert rows[2].region == "delivered" and rows[3].region == "delivered" and rows[2].gender is None


def test_messages_go_to_the_topic_of_their_type(spark):
    events = raw(spark, (1, 2, 3, "cart", "사용자"), (1, 2, 4, "strange", None))
    got = {json.loads(r.value)["ts"]: r for r in ingest.to_messages(events).collect()}
    assert (got[3].topic, got[3].key) == ("shop.carts", "사용자")
    assert json.loads(got[3].value) == {
        "session_id": 1, "aid": 2, "ts": 3, "event_type": "cart", "user_id": "사용자"
    }
    assert "사용자" in got[3].value
    assert (got[4].topic, got[4].key) == (None, None)


def test_raw_path_pads_and_has_a_place_for_missing_types(spark):
    frame = spark.createDataFrame([("click", 1704445505000), (None, 0)], "t STRING, ts BIGINT")
    paths = frame.select(ingest.raw_path(F.col("t"), utc_time(F.col("ts")))).collect()
    assert [r[0] for r in paths] == ["click/2024/01/05/09", "unknown/1970/01/01/00"]


def test_log_lines_are_bounded_and_hold_every_event(spark, sf_dir):
    lines = fixtures.sessions(spark, sf_dir)
    sizes = lines.agg(F.max(F.size("events")), F.sum(F.size("events"))).first()
    assert sizes[0] <= fixtures.EVENTS_PER_LINE
    assert sizes[1] == fixtures.table(spark, sf_dir, "events").count()


def test_deliveries_add_copies_and_lose_nothing(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").count()
    copies = Counter(
        r["count"] for r in fixtures.raw(spark, sf_dir).groupBy("session_id", "ts").count().collect()
    )
    assert copies == {1: events - events // 10, 2: events // 10}

"""The plans Spark makes: what is read, what is shuffled."""

from __future__ import annotations

import re

import pytest

from clickmart.operators import clean, ingest, marts, quality
from clickmart.plans import daily, fixtures
from clickmart.plans.queries import QUERIES
from clickmart.sources import files


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stg_path(spark, sf_dir):
    path = files.scratch_dir(spark, "plans")
    files.write_stg(fixtures.stg(spark, sf_dir), path)
    return path


@pytest.fixture
def stg(spark, stg_path):
    return files.read_stg(spark, stg_path)


def read_columns(frame):
    return [re.findall(r"(\w+):", s) for s in re.findall(r"ReadSchema: struct<([^>]*)", plan(frame))]


def shuffles(frame):
    return plan(frame).count("Exchange hashpartitioning")


def test_row_counts_read_no_columns(stg):
    # Without columns only the files' footers are read.
    assert read_columns(daily._counts("stg", stg)) == [[]]
    assert read_columns(daily._counts("stg", stg, "sessions")) == [["session_id"]]


def test_funnel_reads_only_partition_columns(stg):
    assert read_columns(marts.funnel_daily(stg)) == [[]]
    assert shuffles(marts.funnel_daily(stg)) == 1


def test_marts_read_the_staging_table_once_and_few_columns(stg):
    assert read_columns(marts.item_stats(stg)) == [["aid"]]
    assert read_columns(marts.cohort(stg)) == [["user_id"]]
    expected = {"session_id", "event_dt", "user_id", "region", "platform"}
    assert [set(c) for c in read_columns(marts.session(stg))] == [expected]
    for mart in (marts.item_stats, marts.session):
        assert shuffles(mart(stg)) == 1


def test_staging_filters_prune_partitions(spark, stg_path):
    text = plan(files.read_stg(spark, stg_path, days=["2024-01-10"], types=["cart"]))
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", text).group(1)
    assert "event_date" in filters and "event_type" in filters


def test_cleaning_filters_before_the_only_shuffle(spark, sf_dir, tmp_path):
    fixtures.raw(spark, sf_dir).write.json(str(tmp_path / "raw"))
    events = spark.read.schema(fixtures.schemas.RAW).json(str(tmp_path / "raw"))
    text = plan(clean.transform(events))
    assert text.count("Exchange") == 1
    exchange = text.index("Exchange hashpartitioning")
    assert exchange < text.index("partial_min") < text.index("Filter")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "IsNotNull(aid)" in pushed and "In(event_type" in pushed


def test_cohorts_are_combined_by_hash(stg):
    text = plan(marts.cohort(stg))
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
    scan = text[text.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in scan and "Sort " not in scan


def test_checks_combine_copies_before_the_shuffle(stg):
    text = plan(quality.run_checks(stg))
    assert shuffles(quality.run_checks(stg)) == 1 and "SortAggregate" not in text
    assert text.rindex("partial_count") > text.index("Exchange hashpartitioning")


def test_small_dimensions_are_broadcast_and_large_ones_are_not(stg, spark, sf_dir):
    users = files.scratch_table(spark, fixtures.users(spark, sf_dir), "users")
    assert "BroadcastHashJoin" in plan(ingest.enrich(stg, users))
    assert shuffles(ingest.enrich(stg, users)) == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ingest.enrich(stg, users))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


NO_WRITES = sorted(
    name for name in QUERIES
    if not re.search("roundtrip|stream|scan|daily|incremental|dq_type|gate", name)
)


@pytest.mark.parametrize("name", NO_WRITES)
def test_no_query_uses_python_rows_or_pairs_everything(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InMemoryRelation"):
        assert node not in text

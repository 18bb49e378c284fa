from __future__ import annotations

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_ingest import same

from clickmart import jobs
from clickmart.fixed_values import MART_TABLES
from clickmart.operators import ingest, marts
from clickmart.plans import daily, fixtures
from clickmart.sources import files, jdbc


@pytest.fixture(scope="module")
def shop(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("shop"))
    files.write_raw(fixtures.raw(spark, sf_dir), f"{base}/raw", fixtures.arrival())
    files.write_users(fixtures.users(spark, sf_dir), f"{base}/users")
    return base


@pytest.fixture
def database(spark):
    url = f"jdbc:derby:memory:jobs{uuid.uuid4().hex};create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    settings = {"spark.clickmart.jdbc.url": url, "spark.clickmart.jdbc.driver": options["driver"]}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield url, options
    for key in settings:
        spark.conf.unset(key)


def test_jobs_one_after_the_other(spark, sf_dir, shop, database, capsys):
    url, options = database
    jobs.main(["transform", "--raw", f"{shop}/raw", "--ext", "json", "--users", f"{shop}/users", "--base", shop])
    expected = ingest.enrich(fixtures.stg(spark, sf_dir), fixtures.users(spark, sf_dir))
    assert same(files.read_stg(spark, daily.shop(spark, shop)), expected)
    jobs.main(["check", "--base", shop])
    assert capsys.readouterr().out.count("PASS") == 8
    jobs.main(["marts", "--base", shop])
    jobs.main(["load-marts", "--base", shop])
    for mart, table in MART_TABLES.items():
        rows = files.read_mart(spark, daily.shop(spark, shop), mart).count()
        assert jdbc.count_rows(spark, url, table, options) == rows > 0
    jobs.main(["load-stg", "--base", shop])
    assert jdbc.count_rows(spark, url, "stg_events", options) == expected.count()
    with pytest.raises(ValueError, match="already has rows"):
        jobs.main(["load-stg", "--base", shop, "--days", "2024-01-15"])
    assert jdbc.count_rows(spark, url, "stg_events", options) == expected.count()


def test_a_day_is_loaded_once(spark, sf_dir, database, tmp_path):
    url, options = database
    stg = fixtures.stg(spark, sf_dir)
    files.write_stg(stg.filter("event_date < date'2024-01-15'"), f"{tmp_path}/stg")
    loaded = jdbc.load_stg(spark, f"{tmp_path}/stg", url, options)
    files.write_stg(stg, f"{tmp_path}/stg")
    day = jdbc.load_stg(spark, f"{tmp_path}/stg", url, options, days=("2024-01-15",))
    assert day == stg.filter("event_date = date'2024-01-15'").count() > 0
    with pytest.raises(ValueError, match="already has rows"):
        jdbc.load_stg(spark, f"{tmp_path}/stg", url, options, days=("2024-01-15",))
    assert jdbc.count_rows(spark, url, "stg_events", options) == loaded + day


def test_a_broken_contract_stops_the_load(spark, sf_dir, database, tmp_path):
    url, options = database
    stg = fixtures.stg(spark, sf_dir).withColumn("user_id", F.repeat("user_id", F.lit(70)))
    files.write_stg(stg, f"{tmp_path}/stg")
    with pytest.raises(ValueError, match="length.user_id"):
        jdbc.load_stg(spark, f"{tmp_path}/stg", url, options)
    for name in MART_TABLES:
        files.write_mart(marts.build(stg, name), str(tmp_path), name)
    with pytest.raises(ValueError, match="mart_session"):
        jdbc.load_marts(spark, str(tmp_path), url, options)


def test_a_missing_database_is_named(shop):
    with pytest.raises(ValueError, match="spark.clickmart.jdbc.url"):
        jobs.main(["load-marts", "--base", shop])


def test_a_run_over_one_arrival_day_leaves_all_other_days(spark, shop, tmp_path):
    base, raw = str(tmp_path), ["--raw", f"{shop}/raw", "--ext", "json", "--base", str(tmp_path)]
    jobs.main(["run", *raw])
    whole = files.read_stg(spark, daily.shop(spark, base)).collect()
    for _ in range(2):
        jobs.main(["run", *raw, "--days", "2024-01-15"])
        assert Counter(files.read_stg(spark, daily.shop(spark, base)).collect()) == Counter(whole)
    funnel = files.read_mart(spark, daily.shop(spark, base), "funnel_daily")
    assert funnel.count() == len({r.event_date for r in whole})


def test_a_first_run_may_have_days(spark, shop, tmp_path):
    jobs.main(["transform", "--raw", f"{shop}/raw", "--ext", "json", "--days", "2024-01-15", "--base", str(tmp_path)])
    stg = files.read_stg(spark, daily.shop(spark, str(tmp_path)))
    assert {str(r[0]) for r in stg.select("event_date").distinct().collect()} == {"2024-01-15"}


def test_types_do_not_restrict_a_run(shop, tmp_path):
    with pytest.raises(SystemExit):
        jobs.main(["run", "--raw", f"{shop}/raw", "--types", "cart", "--base", str(tmp_path)])


def test_check_fails_on_an_empty_table(spark, shop, tmp_path):
    daily.stage(spark, files.read_raw(spark, f"{shop}/raw", ext="json").limit(0), str(tmp_path))
    with pytest.raises(ValueError, match="quality"):
        jobs.main(["check", "--base", str(tmp_path)])


def test_user_stats(shop, capsys):
    jobs.main(["user-stats", "--users", f"{shop}/users"])
    out = capsys.readouterr().out
    assert "MACHINERY" in out and "50대" in out


def test_missing_options_are_refused():
    with pytest.raises(SystemExit):
        jobs.main(["transform", "--raw", "x"])

"""Published states: all tables change together, a broken run changes nothing, marts by deltas equal a rebuild."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_ingest import same

from clickmart import schemas
from clickmart.fixed_values import MART_TABLES
from clickmart.operators import clean, ingest, marts
from clickmart.plans import daily, fixtures
from clickmart.sources import files, published

HOUR, DAY = 3_600_000, 86_400_000
PROFILE = (None,) * 5


def raw(spark, rows):
    return spark.createDataFrame([(*r, *PROFILE)[:10] for r in rows], schemas.RAW)


def first(spark):
    return raw(spark, [(1, 7, HOUR, "click", "a"), (1, 7, 2 * DAY, "cart", "a"), (2, 8, DAY, "click", "b")])


def second(spark):
    return raw(spark, [(1, 9, 2 * DAY + 5, "order", "a"), (3, 8, 2 * DAY + 6, "click", "c")])


def content(spark, base):
    state = daily.shop(spark, base)
    tables = {name: files.read_mart(spark, state, name) for name in MART_TABLES}
    tables["stg"] = files.read_stg(spark, state)
    return {name: Counter(map(tuple, table.collect())) for name, table in tables.items()}


def rebuilt(spark, base):
    """The marts of the published staging table, built anew."""
    stg = files.read_stg(spark, daily.shop(spark, base))
    return {name: Counter(map(tuple, marts.build(stg, name).collect())) for name in MART_TABLES}


class Killed(Exception):
    pass


class Steps:
    """Ends the run before its ``last``-th step that changes the file system."""

    def __init__(self, monkeypatch, last):
        self.left = last
        for place, name in ((published, "write"), (published, "commit"), (files, "remove")):
            monkeypatch.setattr(place, name, self.counted(getattr(place, name)))

    def counted(self, step):
        def run(*args, **more):
            if self.left == 0:
                raise Killed
            self.left -= 1
            return step(*args, **more)

        return run


@pytest.mark.parametrize("last", [1, 4, 9])
def test_a_run_that_is_killed_leaves_the_state_before_and_can_be_repeated(spark, tmp_path, monkeypatch, last):
    base = str(tmp_path)
    daily.run(spark, first(spark), base)
    before = content(spark, base)
    with monkeypatch.context() as patched:
        Steps(patched, last)
        with pytest.raises(Killed):
            daily.run(spark, second(spark), base, merge=True)
    assert content(spark, base) == before
    daily.run(spark, second(spark), base, merge=True)
    after = content(spark, base)
    whole = clean.transform(first(spark).union(second(spark)))
    assert after["stg"] == Counter(map(tuple, whole.collect()))
    assert {name: after[name] for name in MART_TABLES} == rebuilt(spark, base)
    published.clean(spark, base, keep=1)
    assert content(spark, base) == after
    named = {a for parts in daily.shop(spark, base).tables.values() for a in parts.values()}
    assert {p.name.removeprefix("v=") for p in tmp_path.glob("*/v=*")} == named


def test_a_commit_cut_short_is_no_state(spark, tmp_path):
    base = str(tmp_path)
    daily.stage(spark, first(spark), base)
    number = daily.shop(spark, base).number
    (tmp_path / "_published" / f".{number + 1}-half").write_text('{"tables": {')
    assert daily.shop(spark, base).number == number


def test_two_runs_at_a_time_are_refused(spark, tmp_path):
    base = str(tmp_path)
    daily.stage(spark, first(spark), base)
    old = published.state(spark, base)
    published.commit(spark, old)
    with pytest.raises(RuntimeError, match="another run"):
        published.commit(spark, old)


def test_readers_of_an_older_state_keep_their_tables(spark, tmp_path):
    base = str(tmp_path)
    daily.run(spark, first(spark), base)
    old = daily.shop(spark, base)
    rows = files.read_stg(spark, old).collect()
    daily.run(spark, second(spark), base, merge=True)
    published.clean(spark, base, keep=2)
    assert files.read_stg(spark, published.state(spark, base, old.number)).collect() == rows
    assert len(published.numbers(spark, base)) == 2


def test_a_second_run_changes_nothing(spark, sf_dir, tmp_path):
    """Also without the users that have filled the stored profiles."""
    base, events = str(tmp_path), fixtures.raw(spark, sf_dir)
    daily.run(spark, events, base, fixtures.users(spark, sf_dir))
    before = content(spark, base)
    day = events.filter(fixtures.arrival().cast("date") == F.to_date(F.lit("2024-01-15")))
    for _ in range(2):
        daily.run(spark, day, base, merge=True)
        assert content(spark, base) == before


def test_stored_profiles_stay_and_gaps_are_filled(spark):
    columns = schemas.columns(schemas.RAW)
    stored = [(1, 1, 5, "click", "b", "F", None, "kr", None, "web"), (2, 1, 5, "click", "b", "F", *PROFILE[:4])]
    arrived = [(1, 1, 5, "click", "b", "M", "20", None, None, "app"), (2, 1, 5, "click", "a", None, "30", *PROFILE[:3]),
               (3, 1, 5, "click", "c", *PROFILE)]
    sides = (spark.createDataFrame(rows, schemas.RAW) for rows in (stored, arrived))
    merged = clean.merge(*sides)
    assert merged.columns == columns
    assert sorted(map(tuple, merged.collect())) == [
        (1, 1, 5, "click", "b", "F", "20", "kr", None, "web"), (2, 1, 5, "click", "a", None, "30", None, None, None),
        (3, 1, 5, "click", "c", *PROFILE),
    ]


def random_events(seed, n, late=0):
    rng = random.Random(seed)
    times = [rng.randrange(4) * DAY + rng.choice([1, 5, HOUR, DAY - 1]) + late for _ in range(n)] + [-(10**17)] * (seed % 2)
    return [
        (rng.randrange(6), rng.randrange(5), t, rng.choice(["click", "cart", "order"]), rng.choice("ab"),
         None, None, rng.choice([None, "x"]), None, rng.choice([None, "web"])) for t in times
    ]


def test_marts_by_deltas_equal_a_rebuild(spark, tmp_path):
    """Sessions over several days, users that change, profiles that are filled, times without a date, new days."""
    base = str(tmp_path)
    users = spark.createDataFrame([("a", "F", "kr")], "user_id string, gender string, region string")
    users = users.selectExpr("*", *(f"string(null) AS {c}" for c in schemas.columns(schemas.USERS) if c not in users.columns))
    daily.run(spark, spark.createDataFrame(random_events(0, 60), schemas.RAW), base)
    for seed, n, late, known in ((1, 12, 0, None), (2, 5, 40 * DAY, users), (3, 1, 0, users), (4, 25, DAY, None)):
        rows = spark.createDataFrame(random_events(seed, n, late), schemas.RAW)
        daily.run(spark, rows, base, known, merge=True)
        found = content(spark, base)
        assert {name: found[name] for name in MART_TABLES} == rebuilt(spark, base)


def test_a_run_over_one_day_reads_that_day_and_those_its_sessions_reach(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    rows = [(s, 1, d * DAY + s, "click", "u") for s in range(5) for d in range(40 * s, 40 * s + 8)]
    daily.run(spark, raw(spark, rows), base)
    asked = []

    def read(spark, state, table, schema, parts=None, plain=published.read):
        asked.append((table, None if parts is None else set(parts)))
        return plain(spark, state, table, schema, parts)

    monkeypatch.setattr(published, "read", read)
    # A new session on a day of its own, and an earlier event of session 1, which started the day after.
    daily.run(spark, raw(spark, [(9, 1, 400 * DAY, "cart", "u")]), base, merge=True)
    days = set().union(*(p for t, p in asked if t == "stg"))
    assert days == {"event_date=1971-02-05"}
    asked.clear()
    # Session 1 starts on day 40; a copy of its first event arrives again.
    daily.run(spark, raw(spark, [(1, 1, 40 * DAY + 1, "click", "u")]), base, merge=True)
    days = set().union(*(p for t, p in asked if t == "stg"))
    assert days == {f"event_date=1970-02-{d:02}" for d in range(10, 18)}
    assert {p for t, p in asked if t == "stg" and p is None} == set()


def test_a_run_after_a_bare_transform_builds_all_marts(spark, tmp_path):
    base = str(tmp_path)
    daily.run(spark, first(spark), base)
    daily.stage(spark, raw(spark, [(5, 5, 5 * DAY, "click", "z")]), base, merge=True)
    assert daily.shop(spark, base).behind
    daily.run(spark, second(spark), base, merge=True)
    found = content(spark, base)
    assert {name: found[name] for name in MART_TABLES} == rebuilt(spark, base) and not daily.shop(spark, base).behind


def test_reading_some_days_lists_no_others(spark, tmp_path):
    base = str(tmp_path)
    daily.run(spark, first(spark), base)
    stg = files.read_stg(spark, daily.shop(spark, base), days=["1970-01-02", "1980-01-01"], types=["click"])
    assert [r.session_id for r in stg.collect()] == [2]
    assert all("event_date=1970-01-02" in f for f in stg.inputFiles())


def test_delta_of_enriched_tables_with_a_large_dimension(spark, sf_dir, tmp_path):
    base, events, users = str(tmp_path), fixtures.raw(spark, sf_dir), fixtures.users(spark, sf_dir)
    daily.run(spark, events, base, users)
    assert same(files.read_stg(spark, daily.shop(spark, base)), ingest.enrich(clean.transform(events), users))

"""The daily run: raw to staging, checks, marts, load. Each step is also a function of its own.

Staging table, marts and what the marts are kept from are published together (``sources.published``): readers see the
tables of one run or those of the run before, and a run that breaks off can be repeated.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import MART_TABLES
from clickmart.operators import clean, deltas, ingest, marts, quality
from clickmart.sources import files, jdbc, published
from clickmart.sources.published import State

#: Folders of days and months without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
MONTHS = "user_months"


def shop(spark: SparkSession, base: str) -> State:
    """The tables as published last."""
    found = published.state(spark, base)
    if found is None:
        raise ValueError(f"nothing has been published in {base}")
    return found


@contextmanager
def _scratch(spark: SparkSession, rows: DataFrame, name: str) -> Iterator[DataFrame]:
    path = files.scratch_dir(spark, name)
    rows.write.parquet(path)
    yield spark.read.schema(rows.schema).parquet(path)
    files.remove(spark, path)


def _parts(column: str, values: DataFrame) -> list[str]:
    """Folder names of the distinct values of a date column, one per calendar day at most."""
    found = values.select(F.col(column).cast("string")).distinct().collect()
    return [f"{column}={NO_VALUE if r[0] is None else r[0]}" for r in found]


def _stg(spark: SparkSession, state: State, parts: list[str] | None = None) -> DataFrame:
    return published.read(spark, state, "stg", schemas.STG, parts)


def _stage(
    spark: SparkSession, raw: DataFrame, old: State, attempt: str, users: DataFrame | None, merge: bool
) -> tuple[State, list[str] | None]:
    """The state with the staging table of a run, and the folders of the days it touches (None: all)."""

    def written(rows: DataFrame) -> dict[str, str]:
        filled = rows if users is None else ingest.enrich(rows, users)
        return published.write(filled, old, "stg", attempt, schemas.STG_PARTITIONS)

    if not merge:
        return old.with_parts("stg", written(clean.transform(raw))), None
    with _scratch(spark, clean.transform(raw), "arrived") as arrived:
        days = _parts("event_date", arrived)
        parts = written(clean.merge(_stg(spark, old, days), arrived))
    return old.with_parts("stg", parts, days), days


def stage(
    spark: SparkSession,
    raw: DataFrame,
    base: str,
    users: DataFrame | None = None,
    merge: bool = False,
) -> DataFrame:
    """Clean ``raw``, fill the profiles from ``users``, publish the staging table and return it.

    Without ``merge`` the table is replaced. With it, ``raw`` is what some arrival days brought: the
    event days it touches, late ones too, are united with their stored rows (``clean.merge``) and
    replaced; all other days stay as they are, and a second run changes nothing, with users or without.
    """
    old = published.draft(spark, base)
    new, _ = _stage(spark, raw, old, published.attempt(old), users, merge)
    return files.read_stg(spark, published.commit(spark, replace(new, behind=True)))


def _built(spark: SparkSession, state: State, attempt: str) -> State:
    """The state with all marts from its whole staging table."""
    stg = _stg(spark, state)
    for name in MART_TABLES:
        state = _with_mart(state, attempt, name, _mart(spark, stg, state, name), None)
        if name == "funnel_daily":
            # What the cohorts are made of comes first.
            months = published.write(deltas.user_months(stg), state, MONTHS, attempt, ("month",))
            state = state.with_parts(MONTHS, months)
    return replace(state, behind=False)


def _mart(spark: SparkSession, stg: DataFrame, state: State, name: str) -> DataFrame:
    return _cohort(spark, state) if name == "cohort" else marts.build(stg, name)


def _cohort(spark: SparkSession, state: State) -> DataFrame:
    months = published.read(spark, state, MONTHS, deltas.USER_MONTHS)
    cohorts = marts.cohort_of_months(months.select("user_id", F.col("month").alias("activity")))
    return cohorts.select(*schemas.columns(schemas.MARTS["cohort"]))


def _with_mart(state: State, attempt: str, name: str, rows: DataFrame, parts: list[str] | None) -> State:
    if name != "session":
        return state.with_parts(name, published.write(rows, state, name, attempt))
    # Sessions lie by the day they start, so that a run replaces few of them.
    dated = rows.withColumn("start_date", F.to_date("session_start"))
    return state.with_parts(name, published.write(dated, state, name, attempt, ("start_date",)), parts)


def _updated(spark: SparkSession, old: State, new: State, attempt: str, days: list[str]) -> State:
    """The state with marts made from those of ``old`` and the touched days alone."""
    gone, came = _stg(spark, old, days), _stg(spark, new, days)
    before = {name: files.read_mart(spark, old, name) for name in MART_TABLES}

    dates = [d.removeprefix("event_date=") for d in days if not d.endswith(NO_VALUE)]
    touched = F.col("dt").isin([F.to_date(F.lit(d)) for d in dates])
    if len(dates) < len(days):
        touched = touched | F.col("dt").isNull()
    kept = before["funnel_daily"].filter(~F.coalesce(touched, F.lit(False)))
    new = _with_mart(new, attempt, "funnel_daily", kept.unionByName(marts.build(came, "funnel_daily")), None)
    new = _with_mart(new, attempt, "item_stats", deltas.item_stats(before["item_stats"], gone, came), None)

    both = gone.select("event_date").unionByName(came.select("event_date")).filter("event_date IS NOT NULL")
    months = _parts("month", both.select(F.trunc("event_date", "month").alias("month")))
    stored = published.read(spark, old, MONTHS, deltas.USER_MONTHS, months)
    written = published.write(deltas.user_months_after(stored, gone, came), new, MONTHS, attempt, ("month",))
    new = new.with_parts(MONTHS, written, months)
    new = _with_mart(new, attempt, "cohort", _cohort(spark, new), None)

    def other_days(found: DataFrame) -> DataFrame:
        return _stg(spark, old, [p for p in _parts("event_date", found) if p not in set(days)])

    with _scratch(spark, deltas.touched_sessions(before["session"], gone, came), "sessions") as changed:
        with _scratch(spark, deltas.sessions(changed, gone, came, other_days), "sessions") as after:
            starts = changed.select("session_start").unionByName(after.select("session_start"))
            parts = _parts("start_date", starts.select(F.to_date("session_start").alias("start_date")))
            there = published.read(spark, old, "session", schemas.MARTS["session"], parts)
            left = there.join(changed, deltas.same_session(there, changed), "left_anti")
            return _with_mart(new, attempt, "session", left.unionByName(after), parts)


def build_marts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Build all marts from the published staging table, publish them and return them by name."""
    old = shop(spark, base)
    new = published.commit(spark, _built(spark, old, published.attempt(old)))
    return {name: files.read_mart(spark, new, name) for name in MART_TABLES}


def run(
    spark: SparkSession,
    raw: DataFrame,
    base: str,
    users: DataFrame | None = None,
    jdbc_url: str | None = None,
    jdbc_options: Mapping[str, str] | None = None,
    merge: bool = False,
) -> DataFrame:
    """Run all steps and return (step, rows, sessions); sessions where the step has them.

    A failed check stops the run before anything is published. Each step starts from the table the
    step before has written, not from its plan, and so do the counts. Raw lines are counted without
    being parsed again. With ``merge`` (see ``stage``) only the touched days are checked, and marts are
    made from those before and the touched days, unless the marts are older than the staging table.
    """
    old = published.draft(spark, base)
    attempt = published.attempt(old)
    new, days = _stage(spark, raw, old, attempt, users, merge)
    if days is None or old.behind or set(MART_TABLES) - set(old.tables):
        quality.gate(_stg(spark, new))
        new = _built(spark, new, attempt)
    else:
        quality.gate(_stg(spark, new, days))
        new = _updated(spark, old, new, attempt, days)
    new = published.commit(spark, new)
    tables = {"raw": raw.select()} | {name: files.read_mart(spark, new, name) for name in MART_TABLES}
    if jdbc_url:
        jdbc.load_marts(spark, new, jdbc_url, jdbc_options or {})
    counts = [_counts(name, t, "sessions" if name == "session" else None) for name, t in tables.items()]
    # The session mart holds every staging row's session, so the staging table is not grouped again.
    counts.append(_counts("stg", tables["session"], "sessions", F.sum("event_count")))
    return reduce(DataFrame.unionByName, counts)


def _counts(step: str, table: DataFrame, sessions: str | None = None, rows: Column | None = None) -> DataFrame:
    number = F.count_distinct("session_id") if sessions else F.lit(None).cast("bigint")
    return table.agg(
        F.lit(step).alias("step"),
        F.coalesce(F.count(F.lit(1)) if rows is None else rows, F.lit(0)).alias("rows"),
        number.alias("sessions"),
    )

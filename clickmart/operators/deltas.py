"""Marts kept by deltas: from the mart before, and the touched days' rows before (``gone``) and after (``new``).

Counts are sums, so what the touched days had is taken away and what they have now is added; no other day is read. Ends
of a session are no sums: if the rows taken away held one, and the session has rows on other days, these days are read
for it, and only they. Each result equals the mart built anew from the whole staging table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import EVENT_TYPES
from clickmart.functions.times import seconds_between
from clickmart.operators import marts
from clickmart.operators.marts import SESSION_KEY

COUNTS = tuple(f"{t}_count" for t in EVENT_TYPES)
SESSION_SUMS = ("event_count", *COUNTS)
USER_MONTHS = "user_id STRING, events BIGINT, month DATE"


def _signed(gone: DataFrame, new: DataFrame, key: Sequence[Column], sums: Sequence[Column]) -> DataFrame:
    """Sums of ``new`` less those of ``gone`` per key; each side is combined before they meet."""
    sides = []
    for rows, sign in ((gone, -1), (new, 1)):
        counted = rows.groupBy(*key).agg(*sums)
        names = counted.columns[len(key) :]
        sides.append(counted.select(*counted.columns[: len(key)], *((F.col(c) * sign).alias(c) for c in names)))
    return sides[0].unionByName(sides[1])


def item_stats(mart: DataFrame, gone: DataFrame, new: DataFrame) -> DataFrame:
    """Item statistics from the mart before; items whose last event went away go, too."""
    number = F.count(F.lit(1)).alias("events")
    signed = _signed(gone, new, [F.col("aid")], [*marts.type_counts(), number])
    # Staging rows have a known type each, so the counts of a mart row add up to its events.
    before = mart.select("aid", *COUNTS, sum(F.col(c) for c in COUNTS).alias("events"))
    totals = before.unionByName(signed).groupBy("aid").agg(*(F.sum(c).alias(c) for c in (*COUNTS, "events")))
    rated = marts.item_rates(totals.filter("events > 0").drop("events"))
    return rated.select(*schemas.columns(schemas.MARTS["item_stats"]))


def user_months(stg: DataFrame) -> DataFrame:
    """Events per user and month: what the cohorts are made of, and what deltas can be added to."""
    known = stg.filter(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
    month = F.trunc("event_date", "month").alias("month")
    return known.groupBy("user_id", month).agg(F.count(F.lit(1)).alias("events"))


def user_months_after(months: DataFrame, gone: DataFrame, new: DataFrame) -> DataFrame:
    """``user_months`` of the touched months from those before."""
    sides = [user_months(new), user_months(gone).withColumn("events", -F.col("events"))]
    every = months.unionByName(sides[0]).unionByName(sides[1])
    return every.groupBy("user_id", "month").agg(F.sum("events").alias("events")).filter("events > 0")


def same_session(a: DataFrame, b: DataFrame) -> Column:
    """Whether two rows have the same session key; missing parts of it count as equal."""
    same = F.lit(True)
    for c in SESSION_KEY:
        same = same & a[c].eqNullSafe(b[c])
    return same


def touched_sessions(mart: DataFrame, gone: DataFrame, new: DataFrame) -> DataFrame:
    """The mart's rows of sessions that have rows in ``gone`` or ``new``."""
    keys = gone.select(*SESSION_KEY).unionByName(new.select(*SESSION_KEY)).distinct()
    return mart.join(keys, same_session(mart, keys), "left_semi")


def sessions(
    before: DataFrame, gone: DataFrame, new: DataFrame, other_days: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows after of all sessions in ``gone`` or ``new``; ``before`` has their rows before (a written table).

    ``other_days`` gives the staging rows of days (``event_date``) that were not touched.
    """
    taken, added = marts.session_parts(gone), marts.session_parts(new)
    both = before.join(taken, same_session(before, taken))
    lost = (before["session_start"] == taken["session_start"]) | (before["session_end"] == taken["session_end"])
    edge = both.filter(lost & (before["event_count"] > taken["event_count"])).select(
        *(before[c] for c in (*SESSION_KEY, "session_start", "session_end"))
    )
    span = F.sequence(F.to_date("session_start"), F.to_date("session_end"))
    rest = other_days(edge.select(F.explode(span).alias("event_date")).distinct())
    rest = marts.session_parts(rest.join(edge.select(*SESSION_KEY), same_session(rest, edge), "left_semi"))
    tagged = [rows.select(*SESSION_KEY, "session_start", "session_end", *SESSION_SUMS, F.lit(kind).alias("kind"))
              for kind, rows in (("before", before), ("gone", taken), ("new", added), ("rest", rest))]
    every = tagged[0]
    for rows in tagged[1:]:
        every = every.unionByName(rows)

    def of(kind: str, column: str) -> Column:
        # One row of each kind at most.
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    sign = F.when(F.col("kind") == "gone", -1).when(F.col("kind") == "rest", 0).otherwise(1)
    merged = every.groupBy(*SESSION_KEY).agg(
        *(of(kind, c).alias(f"{kind}_{c}") for kind in ("before", "gone", "new", "rest")
          for c in ("session_start", "session_end")),
        *(F.sum(F.col(c) * sign).alias(c) for c in SESSION_SUMS),
    )

    def end(column: str, best: Callable[..., Column]) -> Column:
        held = F.coalesce(F.col(f"gone_{column}") == F.col(f"before_{column}"), F.lit(False))
        kept = F.when(held, F.col(f"rest_{column}")).otherwise(F.col(f"before_{column}"))
        return best(kept, F.col(f"new_{column}")).alias(column)

    ended = merged.filter("event_count > 0").select(
        *SESSION_KEY, end("session_start", F.least), end("session_end", F.greatest), *SESSION_SUMS
    )
    duration = seconds_between(F.col("session_start"), F.col("session_end"))
    return ended.withColumn("duration_sec", duration).select(*schemas.columns(schemas.MARTS["session"]))

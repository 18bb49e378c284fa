"""Schemas (as DDL) and table contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names, types and order of all inputs and tables.

SESSION_LOG = "session BIGINT, events ARRAY<STRUCT<aid: BIGINT, ts: BIGINT, type: STRING>>"

USERS = (
    "user_id STRING, name STRING, gender STRING, age_group STRING, region STRING, city STRING, "
    "email STRING, phone STRING, membership STRING, preferred_device STRING, signup_date STRING"
)

EVENT = "session_id BIGINT, aid BIGINT, ts BIGINT, event_type STRING, user_id STRING"

RAW = f"{EVENT}, gender STRING, age_group STRING, region STRING, membership STRING, platform STRING"

MESSAGE = "topic STRING, key STRING, value STRING"

# event_dt is a zone-less UTC time, so no result depends on the session time zone.
STG = (
    "session_id BIGINT, aid BIGINT, ts BIGINT, event_dt TIMESTAMP_NTZ, event_date DATE, "
    "event_type STRING, user_id STRING, gender STRING, age_group STRING, region STRING, "
    "membership STRING, platform STRING"
)
STG_PARTITIONS = ("event_date", "event_type")
EVENT_ORDER = ("session_id", "ts", "aid", "event_type")

MARTS = {
    "funnel_daily": (
        "dt DATE, click_count BIGINT, cart_count BIGINT, order_count BIGINT, "
        "click_to_cart DOUBLE, cart_to_order DOUBLE, click_to_order DOUBLE"
    ),
    "session": (
        "session_id BIGINT, user_id STRING, platform STRING, region STRING, "
        "session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ, event_count BIGINT, "
        "click_count BIGINT, cart_count BIGINT, order_count BIGINT, duration_sec BIGINT"
    ),
    "cohort": (
        "cohort_month STRING, activity_month STRING, active_users BIGINT, cohort_size BIGINT, "
        "retention_rate DOUBLE"
    ),
    "item_stats": (
        "aid BIGINT, click_count BIGINT, cart_count BIGINT, order_count BIGINT, "
        "cart_rate DOUBLE, order_rate DOUBLE"
    ),
}


def columns(ddl: str) -> list[str]:
    """Top-level column names of a flat DDL schema."""
    return [part.split()[0] for part in ddl.split(", ")]


@dataclass(frozen=True)
class Contract:
    """What a target table accepts: keys, mandatory columns, text lengths, (precision, scale)."""

    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    numerics: dict[str, tuple[int, int]] = field(default_factory=dict)


# Constraints of the target tables.
CONTRACTS = {
    "funnel_daily": Contract(
        key=("dt",),
        not_null=("dt",),
        numerics={"click_to_cart": (5, 2), "cart_to_order": (5, 2), "click_to_order": (5, 2)},
    ),
    "session": Contract(
        key=("session_id",),
        not_null=("session_id", "user_id"),
        lengths={"user_id": 64, "platform": 10, "region": 20},
    ),
    "cohort": Contract(
        key=("cohort_month", "activity_month"),
        not_null=("cohort_month", "activity_month"),
        lengths={"cohort_month": 7, "activity_month": 7},
        numerics={"retention_rate": (5, 2)},
    ),
    "item_stats": Contract(
        key=("aid",),
        not_null=("aid",),
        numerics={"cart_rate": (5, 2), "order_rate": (5, 2)},
    ),
    "stg_events": Contract(
        not_null=("session_id", "aid", "ts", "event_type", "user_id"),
        lengths={
            "event_type": 10, "user_id": 64, "gender": 1, "age_group": 10,
            "region": 20, "membership": 10, "platform": 10,
        },
    ),
}

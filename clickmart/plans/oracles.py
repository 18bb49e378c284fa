"""The same results in DuckDB SQL, written against the given tables."""

from __future__ import annotations

from clickmart.fixed_values import AGE_GROUPS, EVENT_TYPES, LOG_TYPES, MART_TABLES
from clickmart.plans import queries
from clickmart.schemas import CONTRACTS, Contract

PROFILES = "gender, age_group, region, membership, platform"
STG_COLUMNS = (
    f"session_id, aid, ts, event_dt, event_date, event_type, user_id, {PROFILES}"
)
VALID = ", ".join(f"'{t}'" for t in EVENT_TYPES)


def _number(text: str, digits: int = 8) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"


# Building blocks: the common table expressions of the fixture views.

RAW_IDENTIFIED = """
identified AS (
  SELECT event_id,
         user_id * 1000 + dayofyear(ts) AS session_id,
         CASE WHEN event_id % 89 <> 0 THEN (props->>'$.k')::BIGINT END AS aid,
         epoch_us(ts) // 1000 AS ts,
         CASE event_type WHEN 'view' THEN 'click' WHEN 'click' THEN 'cart'
                         WHEN 'purchase' THEN 'order' ELSE event_type END AS event_type,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN user_id % 26 = 0 THEN 'u' || user_id
              ELSE user_id::VARCHAR END AS user_id,
         CASE WHEN user_id % 13 = 0 THEN 'F' END AS gender,
         CASE WHEN user_id % 13 = 0 THEN '20대' END AS age_group,
         CASE WHEN user_id % 13 = 0 THEN 'delivered' END AS region,
         CASE WHEN user_id % 13 = 0 THEN 'VIP' END AS membership,
         CASE WHEN user_id % 13 = 0 THEN 'app' END AS platform
  FROM events)"""

RAW = f"""{RAW_IDENTIFIED},
raw AS (
  SELECT * EXCLUDE (event_id) FROM identified
  UNION ALL
  SELECT * EXCLUDE (event_id) REPLACE ('late' AS platform) FROM identified WHERE event_id % 10 = 0)"""

KEYS = "session_id, aid, ts, event_type"
# Of copies that differ the smallest survives, missing values first.
SURVIVOR = f"""QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY user_id NULLS FIRST,
  gender NULLS FIRST, age_group NULLS FIRST, region NULLS FIRST, membership NULLS FIRST,
  platform NULLS FIRST) = 1"""

STG = f"""{RAW},
stg AS (
  SELECT session_id, aid, ts,
         make_timestamp((ts // 1000) * 1000000) AS event_dt,
         make_timestamp((ts // 1000) * 1000000)::DATE AS event_date,
         event_type, user_id, {PROFILES}
  FROM raw
  WHERE session_id IS NOT NULL AND aid IS NOT NULL AND ts IS NOT NULL
    AND user_id IS NOT NULL AND event_type IN ({VALID})
  {SURVIVOR})"""

USERS = f"""
users AS (
  SELECT c_custkey::VARCHAR AS user_id, c_name AS name,
         CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_acctbal < 0 THEN '10대' WHEN c_acctbal < 2000 THEN '20대'
              WHEN c_acctbal < 4000 THEN '30대' WHEN c_acctbal < 6000 THEN '40대'
              WHEN c_acctbal < 8000 THEN '50대' ELSE '60대 이상' END AS age_group,
         n_name AS region, c_mktsegment AS membership,
         CASE WHEN c_acctbal < 3000 THEN 'web' WHEN c_acctbal < 6000 THEN 'ios'
              ELSE 'android' END AS preferred_device
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

ENRICHED = f"""{STG}, {USERS},
enriched AS (
  SELECT e.session_id, e.aid, e.ts, e.event_dt, e.event_date, e.event_type, e.user_id,
         coalesce(u.gender, e.gender) AS gender, coalesce(u.age_group, e.age_group) AS age_group,
         coalesce(u.region, e.region) AS region,
         coalesce(u.membership, e.membership) AS membership,
         coalesce(u.preferred_device, e.platform) AS platform
  FROM stg e LEFT JOIN users u USING (user_id))"""

LOG = """
log AS (
  SELECT user_id * 1000 + dayofyear(ts) AS session_id, event_id // 1000 AS line,
         (props->>'$.k')::BIGINT AS aid, epoch_us(ts) // 1000 AS ts,
         CASE event_type WHEN 'view' THEN 'clicks' WHEN 'click' THEN 'carts'
                         WHEN 'purchase' THEN 'orders' ELSE event_type END AS type
  FROM events)"""

NORMALIZED = f"""{LOG},
normalized AS (
  SELECT session_id, aid, ts,
         CASE type {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LOG_TYPES.items())} END
           AS event_type
  FROM log)"""

ASSIGNED = f"""{USERS},
numbered AS (
  SELECT user_id,
         row_number() OVER (ORDER BY {_number('user_id')} % 1024, user_id) - 1 AS user_index
  FROM users),
assigned AS (
  SELECT session_id, n.user_id
  FROM (SELECT DISTINCT session_id FROM log)
  JOIN numbered n ON n.user_index =
    {_number('session_id::VARCHAR', 15)} % (SELECT count(*) FROM users))"""

COHORT = """
active AS (
  SELECT DISTINCT o_custkey::VARCHAR AS user_id, strftime(o_orderdate, '%Y-%m') AS activity_month
  FROM orders),
first_month AS (
  SELECT o_custkey::VARCHAR AS user_id, strftime(min(o_orderdate), '%Y-%m') AS cohort_month
  FROM orders GROUP BY 1),
cohort_size AS (
  SELECT cohort_month, count(user_id) AS cohort_size FROM first_month GROUP BY 1)"""


def _counts() -> str:
    return ", ".join(
        f"count(*) FILTER (event_type = '{t}') AS {t}_count" for t in EVENT_TYPES
    )


def _rate(part: str, whole: str, name: str, digits: int = 2) -> str:
    return f"round({part} / nullif({whole}, 0) * 100, {digits}) AS {name}"


FUNNEL = f"""
funnel AS (
  SELECT *, {_rate('cart_count', 'click_count', 'click_to_cart')},
         {_rate('order_count', 'cart_count', 'cart_to_order')},
         {_rate('order_count', 'click_count', 'click_to_order')}
  FROM (SELECT event_date AS dt, {_counts()} FROM stg GROUP BY 1))"""


def _session(source: str) -> str:
    return f"""
sessions AS (
  SELECT *, date_diff('second', session_start, session_end) AS duration_sec
  FROM (SELECT session_id, user_id, platform, region, min(event_dt) AS session_start,
               max(event_dt) AS session_end, count(*) AS event_count, {_counts()}
        FROM {source} GROUP BY ALL))"""


COHORTS = f"""{COHORT},
cohorts AS (
  SELECT cohort_month, activity_month, active_users, cohort_size,
         {_rate('active_users', 'cohort_size', 'retention_rate')}
  FROM (SELECT cohort_month, activity_month, count(DISTINCT user_id) AS active_users
        FROM active JOIN first_month USING (user_id) GROUP BY ALL)
  JOIN cohort_size USING (cohort_month))"""

ITEMS = f"""
items AS (
  SELECT *, {_rate('cart_count', 'click_count', 'cart_rate')},
         {_rate('order_count', 'click_count', 'order_rate')}
  FROM (SELECT aid, {_counts()} FROM stg GROUP BY 1))"""


def _checks(source: str) -> str:
    nulls = [
        f"""SELECT 'null_{c}' AS "check", count(*) = 0 AS passed, count(*) AS n
            FROM {source} WHERE {c} IS NULL"""
        for c in ("session_id", "aid", "ts", "event_type", "user_id")
    ]
    keys = "session_id, aid, ts, event_type"
    return " UNION ALL ".join(
        [
            f"""SELECT 'total_count' AS "check", count(*) > 0 AS passed, count(*) AS n
                FROM {source}""",
            *nulls,
            f"""SELECT 'duplicate', sum(n - 1)::BIGINT = 0, sum(n - 1)::BIGINT
                FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})""",
            f"""SELECT 'invalid_event_type', count(*) = 0, count(*)
                FROM {source} WHERE event_type NOT IN ({VALID})""",
        ]
    )


def _contract(source: str, rules: Contract) -> str:
    parts = [
        f"SELECT 'not_null' AS rule, '{c}' AS \"column\", count(*) AS violations "
        f"FROM {source} WHERE {c} IS NULL"
        for c in rules.not_null
    ]
    parts += [
        f"SELECT 'length', '{c}', count(*) FROM {source} WHERE length({c}) > {n}"
        for c, n in rules.lengths.items()
    ]
    parts += [
        f"SELECT 'numeric', '{c}', count(*) FROM {source} "
        f"WHERE abs(round({c}, {s})) >= {10 ** (p - s)}"
        for c, (p, s) in rules.numerics.items()
    ]
    if rules.key:
        key = ", ".join(rules.key)
        parts.append(
            f"SELECT 'primary_key', '{','.join(rules.key)}', coalesce(sum(n - 1), 0)::BIGINT "
            f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})"
        )
    return " UNION ALL ".join(parts)


def _profile_counts() -> str:
    ages = " ".join(
        f"WHEN dimension = 'age_group' AND value = '{a}' THEN {i}"
        for i, a in enumerate(AGE_GROUPS, 1)
    )
    union = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS value FROM users"
        for d in ("gender", "age_group", "region", "membership")
    )
    return f"""
SELECT dimension, value, n, round(n / sum(n) OVER (PARTITION BY dimension) * 100, 1) AS share,
       row_number() OVER (PARTITION BY dimension ORDER BY
         CASE {ages} WHEN value = 'F' THEN 1 WHEN value = 'M' THEN 2 ELSE 0 END,
         n DESC, value) AS place
FROM (SELECT dimension, value, count(*) AS n FROM ({union}) GROUP BY ALL)"""


DAMAGE = f"""{RAW_IDENTIFIED},
lines AS (
  SELECT event_id % 53 = 0 AS broken, event_id % 53 <> 0 AND event_id % 59 = 0 AS fraction, *
  FROM identified),
read AS (
  SELECT broken OR fraction AS bad,
         {", ".join(f"CASE WHEN NOT broken THEN {c} END AS {c}"
                    for c in ("session_id", "ts", "event_type", "user_id"))},
         CASE WHEN NOT broken AND NOT fraction THEN aid END AS aid, broken, fraction
  FROM lines)"""


def _type_range() -> str:
    # Broken lines name no field, so nothing of theirs counts as a lost field; a fraction loses the item.
    columns = "session_id, aid, ts, event_type, user_id, " + PROFILES
    tests = {"corrupt_record": "bad"}
    tests |= {f"unreadable_{c}": "fraction" if c == "aid" else "false" for c in columns.split(", ")}
    low, high = queries.RANGE_MS
    tests["ts_range"] = f"ts NOT BETWEEN {low} AND {high}"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) = 0 AS passed, count(*) AS n "
        f"FROM read WHERE {test}"
        for name, test in tests.items()
    )


# What is left of an event's JSON, NULL fields left out, behind its first key.
REST = """'"session_id":' || session_id || ',"ts":' || ts || ',"event_type":"' || event_type || '"' ||
  CASE WHEN user_id IS NULL THEN '' ELSE ',"user_id":"' || user_id || '"' END || '}'"""
DAMAGED_VALUE = f"""CASE WHEN ts % 53 = 0 THEN 'broken {{ ' || ts
  WHEN ts % 59 = 0 THEN '{{"campaign":"x",' || {REST}
  WHEN ts % 61 = 0 THEN '{{"aid":2.5,' || {REST} ELSE 'plain ' || ts END"""

PATH = "strftime(make_timestamp(ts * 1000), '%Y/%m/%d/%H')"
TOPIC = "CASE event_type " + " ".join(
    f"WHEN '{event}' THEN 'shop.{log}'" for log, event in LOG_TYPES.items()
) + " END AS topic"
RAW_EVENT = "session_id, aid, ts, event_type, user_id"
MESSAGES = f"WITH {RAW} SELECT {TOPIC}, user_id AS key, {RAW_EVENT} FROM raw"
SELECT_RAW = f"WITH {RAW} SELECT * FROM raw"
SELECT_STG = f"WITH {STG} SELECT {STG_COLUMNS} FROM stg"
SELECT_FUNNEL = f"WITH {STG}, {FUNNEL} SELECT * FROM funnel"


def _mart_values() -> str:
    parts = []
    for mart, cte in zip(MART_TABLES, ("funnel", "sessions", "cohorts", "items"), strict=True):
        key = " || '|' || ".join(f"{c}::VARCHAR" for c in CONTRACTS[mart].key)
        for column in queries.mart_numbers(mart):
            parts.append(
                f"SELECT '{mart}' AS mart, {key} AS key, '{column}' AS \"column\", "
                f"{column}::DOUBLE AS value, true AS created FROM {cte}"
            )
    return " UNION ALL ".join(parts)


EVENT_COHORTS = COHORTS.replace("o_custkey::VARCHAR", "user_id").replace(
    "o_orderdate", "event_dt").replace("FROM orders", "FROM stg")
ALL_MARTS = f"{FUNNEL}, {EVENT_COHORTS}, {ITEMS}"

ORACLES: dict[str, str] = {
    "clean_dropna": f"""WITH {RAW} SELECT * FROM raw WHERE session_id IS NOT NULL AND aid IS NOT NULL
        AND ts IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL""",
    "clean_valid_types": f"WITH {RAW} SELECT * FROM raw WHERE event_type IN ({VALID})",
    "clean_dedup": f"WITH {RAW} SELECT * FROM raw {SURVIVOR}",
    "ts_to_event_dt": f"""WITH {RAW} SELECT session_id, ts,
        make_timestamp((ts // 1000) * 1000000) AS event_dt,
        make_timestamp((ts // 1000) * 1000000)::DATE AS event_date FROM raw""",
    "transform_stg": SELECT_STG,
    "mart_funnel_daily": SELECT_FUNNEL,
    "mart_session": f"WITH {ENRICHED}, {_session('enriched')} SELECT * FROM sessions",
    "mart_cohort": f"WITH {COHORTS} SELECT * FROM cohorts",
    "bitmap_cohort": f"WITH {COHORTS} SELECT * FROM cohorts",
    "bitmap_cohort_size": f"WITH {COHORT} SELECT * FROM cohort_size",
    "bitmap_distinct_sessions": f"""WITH {STG}
        SELECT event_date::VARCHAR AS days, count(DISTINCT session_id) AS n FROM stg GROUP BY 1
        UNION ALL SELECT 'all', count(DISTINCT session_id) FROM stg""",
    "mart_item_stats": f"WITH {STG}, {ITEMS} SELECT * FROM items",
    "user_first_month": f"WITH {COHORT} SELECT * FROM first_month",
    "user_activity_months": f"WITH {COHORT} SELECT * FROM active",
    "cohort_size": f"WITH {COHORT} SELECT * FROM cohort_size",
    "cohort_activity_join": f"""WITH {COHORT} SELECT user_id, activity_month, cohort_month
        FROM active JOIN first_month USING (user_id)""",
    "safe_rate": f"""WITH {STG} SELECT *, {_rate('cart_count', 'click_count', 'cart_rate')},
        {_rate('order_count', 'cart_count', 'order_rate', 1)}
        FROM (SELECT aid, event_date, {_counts()} FROM stg GROUP BY ALL)""",
    "type_stats": f"WITH {STG} SELECT event_type, count(*) AS n FROM stg GROUP BY 1",
    "sample_stg": f"""WITH {STG} SELECT {STG_COLUMNS} FROM stg
        ORDER BY session_id, ts, aid, event_type LIMIT 5""",
    "kst_display": f"""WITH {STG} SELECT session_id, aid, ts, event_type, event_dt,
        event_dt + INTERVAL 9 HOUR AS display_dt FROM stg""",
    "user_profile_stats": f"WITH {USERS} {_profile_counts()}",
    "top_regions": f"""WITH {USERS} SELECT region AS value, count(*) AS n FROM users
        GROUP BY 1 ORDER BY n DESC, value LIMIT 5""",
    "explode_events": f"WITH {LOG} SELECT session_id, aid, ts, type FROM log",
    "normalize_types": f"WITH {NORMALIZED} SELECT * FROM normalized",
    "assign_users": f"WITH {LOG}, {ASSIGNED} SELECT * FROM assigned",
    "build_events": f"""WITH {NORMALIZED}, {ASSIGNED}
        SELECT {RAW_EVENT} FROM normalized JOIN assigned USING (session_id)""",
    "enrich_profile": f"WITH {ENRICHED} SELECT {STG_COLUMNS} FROM enriched",
    "encode_messages": MESSAGES,
    "limit_events": f"""WITH {NORMALIZED} SELECT * FROM normalized
        ORDER BY session_id, ts, aid NULLS FIRST, event_type NULLS FIRST LIMIT 5000""",
    "raw_partition_path": f"""WITH {RAW} SELECT session_id, ts, event_type,
        event_type || '/' || {PATH} AS path FROM raw""",
    "dq_checks": f"""WITH {STG}
        SELECT 'raw' AS input, * FROM ({_checks('raw')})
        UNION ALL SELECT 'stg' AS input, * FROM ({_checks('stg')})""",
    "dq_report": f"""WITH {STG}, checks AS (
          SELECT 'raw' AS input, * FROM ({_checks('raw')})
          UNION ALL SELECT 'stg' AS input, * FROM ({_checks('stg')}))
        SELECT input, "check", n, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status,
          CASE WHEN bool_and(passed) OVER (PARTITION BY input) THEN 'PASS' ELSE 'FAIL' END
            AS verdict
        FROM checks""",
    "dq_gate": SELECT_STG,
    "dq_type_range": f"WITH {DAMAGE} {_type_range()}",
    "contract_funnel": f"WITH {STG}, {FUNNEL} {_contract('funnel', CONTRACTS['funnel_daily'])}",
    "contract_session": f"""WITH {ENRICHED}, {_session('enriched')}
        {_contract('sessions', CONTRACTS['session'])}""",
    "contract_cohort": f"WITH {COHORTS} {_contract('cohorts', CONTRACTS['cohort'])}",
    "contract_item": f"WITH {STG}, {ITEMS} {_contract('items', CONTRACTS['item_stats'])}",
    "contract_stg": f"WITH {ENRICHED} {_contract('enriched', CONTRACTS['stg_events'])}",
    "scan_raw_jsonl": SELECT_RAW,
    "scan_sessions_nested": f"""WITH {LOG} SELECT session_id AS session, count(*) AS events,
        min(ts) AS first_ts, arg_max(type, ts) AS last_type FROM log
        GROUP BY session_id, line""",
    "scan_users": f"""WITH {USERS} SELECT user_id, name, gender, age_group, region,
        NULL::VARCHAR AS city, NULL::VARCHAR AS email, NULL::VARCHAR AS phone, membership,
        preferred_device, NULL::VARCHAR AS signup_date FROM users""",
    "incremental_run": f"WITH {ENRICHED} SELECT {STG_COLUMNS} FROM enriched",
    "incremental_without_users": f"WITH {ENRICHED} SELECT {STG_COLUMNS} FROM enriched",
    "incremental_marts": f"WITH {ENRICHED}, {ALL_MARTS}, {_session('enriched')} {_mart_values()}",
    "stg_roundtrip": SELECT_STG,
    "scan_stg_pruned": f"""{SELECT_STG} WHERE event_date IN
        ({", ".join(f"DATE '{d}'" for d in queries.PRUNED_DAYS)})
        AND event_type IN ({", ".join(f"'{t}'" for t in queries.PRUNED_TYPES)})""",
    "incremental_day": f"""WITH {ENRICHED}
        SELECT {STG_COLUMNS} FROM stg WHERE event_date <> DATE '{queries.REPLACED_DAY}'
        UNION ALL
        SELECT {STG_COLUMNS} FROM enriched WHERE event_date = DATE '{queries.REPLACED_DAY}'""",
    "mart_roundtrip": SELECT_FUNNEL,
    "jdbc_roundtrip_stg": SELECT_STG,
    "jdbc_roundtrip_marts": f"WITH {STG}, {ALL_MARTS}, {_session('stg')} {_mart_values()}",
    "stream_source_decode": MESSAGES.replace(" FROM raw", ", NULL::VARCHAR AS _corrupt_record FROM raw"),
    "stream_raw_landing": f"WITH {RAW} SELECT 'shop' AS topic, user_id AS key, {DAMAGED_VALUE} AS value FROM raw",
    "stream_landing_manifest": f"WITH {RAW} SELECT 'shop' AS topic, user_id AS key, {DAMAGED_VALUE} AS value FROM raw",
    "stream_reconciled": f"""WITH {STG} SELECT session_id, aid, ts, event_dt, event_date, event_type, user_id
        FROM stg""",
    "stream_type_counts": f"WITH {RAW} SELECT event_type, count(*) AS n FROM raw GROUP BY 1",
    "stream_clean": f"""WITH {STG} SELECT session_id, aid, ts, event_dt, event_date, event_type, user_id
        FROM stg""",
    "stream_funnel": SELECT_FUNNEL,
    "stream_session": f"WITH {STG}, {_session('stg')} SELECT * FROM sessions",
    "schema_drift": f"""WITH {RAW_IDENTIFIED},
        fields AS (
          SELECT event_id, ts, unnest(['session_id', 'ts', 'event_type']) AS field,
                 unnest(['integer', 'integer', 'text']) AS kind FROM identified WHERE event_id % 53 <> 0
          UNION ALL SELECT event_id, ts, 'user_id', 'text' FROM identified
          WHERE event_id % 53 <> 0 AND user_id IS NOT NULL
          UNION ALL SELECT event_id, ts, 'aid', CASE WHEN event_id % 59 = 0 THEN 'fraction' ELSE 'integer' END
          FROM identified WHERE event_id % 53 <> 0 AND (aid IS NOT NULL OR event_id % 59 = 0)
          UNION ALL SELECT event_id, ts, 'extra', 'boolean' FROM identified
          WHERE event_id % 53 <> 0 AND event_id % 59 <> 0 AND event_id % 61 = 0
          UNION ALL SELECT event_id, ts, NULL, 'no object' FROM identified WHERE event_id % 53 = 0)
        SELECT strftime(make_timestamp(ts * 1000), '%Y') AS y, strftime(make_timestamp(ts * 1000), '%m') AS m,
               strftime(make_timestamp(ts * 1000), '%d') AS d, field, kind,
               coalesce(field <> 'extra', false) AS known, count(*) AS n
        FROM fields GROUP BY ALL""",
    "daily_run_counts": f"""WITH {ENRICHED}, {ALL_MARTS}, {_session('enriched')}
        SELECT 'raw' AS step, count(*) AS rows, NULL::BIGINT AS sessions FROM raw
        UNION ALL SELECT 'stg', count(*), count(DISTINCT session_id) FROM enriched
        UNION ALL SELECT 'funnel_daily', count(*), NULL FROM funnel
        UNION ALL SELECT 'session', count(*), count(DISTINCT session_id) FROM sessions
        UNION ALL SELECT 'cohort', count(*), NULL FROM cohorts
        UNION ALL SELECT 'item_stats', count(*), NULL FROM items""",
}

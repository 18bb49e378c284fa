"""Inputs in the engine's data model, derived from the whole of the given tables.

The tables hold clean generic events, so repeated deliveries, missing fields and damaged lines are
added by rule. No event is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import AGE_GROUPS, LOG_TYPES
from clickmart.functions.times import epoch_ms, utc_time
from clickmart.operators.clean import transform
from clickmart.operators.ingest import to_messages
from clickmart.sources import files

SOURCE_TYPES = {"view": "click", "click": "cart", "purchase": "order"}
#: Profile that some users' events are delivered with.
DELIVERED = {
    "gender": "F", "age_group": "20대", "region": "delivered", "membership": "VIP", "platform": "app",
}
LATE_PLATFORM = "late"
EVENT_COLUMNS = schemas.columns(schemas.EVENT)
EVENTS_PER_LINE = 1000
#: Balances below which customers count as one age group after the other.
AGE_LIMITS = (0, 2000, 4000, 6000, 8000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_type(names: dict[str, str]) -> Column:
    chain = F
    for source, name in names.items():
        chain = chain.when(F.col("event_type") == source, name)
    return chain.otherwise(F.col("event_type"))


def _session() -> Column:
    return F.col("user_id") * 1000 + F.dayofyear("ts")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a generator the JSON is parsed once per event; as an expression it would be parsed again
    # in every filter on the item.
    events = table(spark, sf_dir, "events")
    parsed = events.select("event_id", "ts", "user_id", "event_type", F.json_tuple("props", "k"))
    return parsed.withColumn("item", F.col("c0").cast("bigint"))


def _identified_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = F.when(F.col("user_id") % 26 == 0, "u").otherwise("")
    return _events(spark, sf_dir).select(
        "event_id",
        _session().alias("session_id"),
        F.when(F.col("event_id") % 89 != 0, F.col("item")).alias("aid"),
        epoch_ms(F.col("ts")).alias("ts"),
        _event_type(SOURCE_TYPES).alias("event_type"),
        F.when(F.col("event_id") % 97 != 0, F.concat(unknown, F.col("user_id"))).alias("user_id"),
        *(F.when(F.col("user_id") % 13 == 0, value).alias(c) for c, value in DELIVERED.items()),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events: some delivered twice, with another platform the second time, some without item or
    user, some of unknown types, some with a profile, some of users that no dimension knows."""
    deliveries = F.when(F.col("event_id") % 10 == 0, 2).otherwise(1)
    delivered = _identified_raw(spark, sf_dir).withColumn(
        "delivery", F.explode(F.sequence(F.lit(1), deliveries))
    )
    late = F.when(F.col("delivery") == 2, LATE_PLATFORM).otherwise(F.col("platform"))
    return delivered.withColumn("platform", late).drop("event_id", "delivery")


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table of ``raw``."""
    return transform(raw(spark, sf_dir))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session log lines. A long session takes several lines of up to ``EVENTS_PER_LINE`` events,
    so no line grows with the data."""
    log_names = {event_type: log_type for log_type, event_type in LOG_TYPES.items()}
    log_types = {source: log_names[event_type] for source, event_type in SOURCE_TYPES.items()}
    events = _events(spark, sf_dir).select(
        _session().alias("session"),
        F.call_function("div", F.col("event_id"), F.lit(EVENTS_PER_LINE)).alias("line"),
        epoch_ms(F.col("ts")).alias("ts"),
        F.col("item").alias("aid"),
        _event_type(log_types).alias("type"),
    )
    lines = events.groupBy("session", "line").agg(
        F.array_sort(F.collect_list(F.struct("ts", "aid", "type"))).alias("events")
    )
    in_log_order = F.transform(
        "events", lambda e: F.struct(*(e[name].alias(name) for name in ("aid", "ts", "type")))
    )
    return lines.select("session", in_log_order.alias("events"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension: every customer, described by nation, market segment and balance."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    balance, age = F.col("c_acctbal"), F
    for upper, group in zip(AGE_LIMITS, AGE_GROUPS, strict=False):
        age = age.when(balance < upper, group)
    known = {
        "user_id": F.col("c_custkey").cast("string"),
        "name": F.col("c_name"),
        "gender": F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M"),
        "age_group": age.otherwise(AGE_GROUPS[-1]),
        "region": F.col("n_name"),
        "membership": F.col("c_mktsegment"),
        "preferred_device": F.when(balance < 3000, "web").when(balance < 6000, "ios").otherwise("android"),
    }
    missing = F.lit(None).cast("string")
    return customer.select(*(known.get(c, missing).alias(c) for c in schemas.columns(schemas.USERS)))


def cohort_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as user activity over many months."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").alias("event_dt"),
        F.col("o_orderdate").cast("date").alias("event_date"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw`` as keyed messages."""
    return to_messages(raw(spark, sf_dir))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``messages`` of which some are no JSON, some have a further key, some an item that is no integer."""
    ts = F.col("ts")
    whole = F.to_json(F.struct(*(F.col(c) for c in EVENT_COLUMNS if c != "aid")))
    value = (
        F.when(ts % 53 == 0, F.concat(F.lit("broken { "), ts.cast("string")))
        .when(ts % 59 == 0, F.concat(F.lit('{"campaign":"x",'), F.substr(whole, F.lit(2))))
        .when(ts % 61 == 0, F.concat(F.lit('{"aid":2.5,'), F.substr(whole, F.lit(2))))
        .otherwise(F.concat(F.lit("plain "), ts.cast("string")))
    )
    events = raw(spark, sf_dir)
    return events.select(F.lit("shop").alias("topic"), F.col("user_id").alias("key"), value.alias("value"))


def arrival() -> Column:
    """Arrival time of a raw event: events arrive at midnight (UTC) of the day they happened."""
    return utc_time(F.col("ts")).cast("date").cast("timestamp_ntz")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of the raw events by landing folder; some are no JSON, some hold an item number
    that is no integer, some an extra key."""
    event_id = F.col("event_id")
    fields = [F.col(c) for c in EVENT_COLUMNS]
    fraction = [F.lit(2.5).alias("aid") if c == "aid" else F.col(c) for c in EVENT_COLUMNS]
    line = (
        F.when(event_id % 53 == 0, F.concat(F.lit("no json: "), event_id.cast("string")))
        .when(event_id % 59 == 0, F.to_json(F.struct(*fraction)))
        .when(event_id % 61 == 0, F.to_json(F.struct(F.lit(True).alias("extra"), *fields)))
        .otherwise(F.to_json(F.struct(*fields)))
    )
    parts = files.landing_parts(F.col("event_type"), arrival())
    return _identified_raw(spark, sf_dir).select(line.alias("line"), *parts)

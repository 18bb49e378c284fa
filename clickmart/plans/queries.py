"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import AGE_GROUPS, GENDERS, MART_TABLES, PROFILE_COLUMNS, STG_TABLE
from clickmart.functions.rates import rate
from clickmart.functions.times import utc_time
from clickmart.operators import clean, distinct, ingest, marts, profile, quality
from clickmart.plans import daily, fixtures
from clickmart.sources import files, jdbc
from clickmart.streaming import events as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REPLACED_DAY, NEXT_DAY = "2024-01-15", "2024-01-16"
PRUNED_DAYS = ("2024-01-10", "2024-01-11", "2024-01-12")
PRUNED_TYPES = ("cart", "order")
RANGE_MS = (1_704_412_800_000, 1_706_140_800_000)
JDBC_URL_SETTING = "spark.clickmart.jdbc.url"
JDBC_DRIVER_SETTING = "spark.clickmart.jdbc.driver"


def query(build: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = build
    return build


# Cleaning


@query
def clean_dropna(spark, sf_dir):
    return clean.drop_null_core(fixtures.raw(spark, sf_dir))


@query
def clean_valid_types(spark, sf_dir):
    return clean.keep_valid_types(fixtures.raw(spark, sf_dir))


@query
def clean_dedup(spark, sf_dir):
    return clean.dedup(fixtures.raw(spark, sf_dir))


@query
def ts_to_event_dt(spark, sf_dir):
    timed = clean.add_event_time(fixtures.raw(spark, sf_dir))
    return timed.select("session_id", "ts", "event_dt", "event_date")


@query
def transform_stg(spark, sf_dir):
    return fixtures.stg(spark, sf_dir)


# Marts


@query
def mart_funnel_daily(spark, sf_dir):
    return marts.build(fixtures.stg(spark, sf_dir), "funnel_daily")


@query
def mart_session(spark, sf_dir):
    enriched = ingest.enrich(fixtures.stg(spark, sf_dir), fixtures.users(spark, sf_dir))
    return marts.build(enriched, "session")


@query
def mart_cohort(spark, sf_dir):
    return marts.build(fixtures.cohort_events(spark, sf_dir), "cohort")


@query
def mart_item_stats(spark, sf_dir):
    return marts.build(fixtures.stg(spark, sf_dir), "item_stats")


@query
def user_first_month(spark, sf_dir):
    return marts.first_month(fixtures.cohort_events(spark, sf_dir))


@query
def user_activity_months(spark, sf_dir):
    return marts.activity_months(fixtures.cohort_events(spark, sf_dir))


@query
def cohort_size(spark, sf_dir):
    return marts.cohort_size(marts.first_month(fixtures.cohort_events(spark, sf_dir)))


@query
def cohort_activity_join(spark, sf_dir):
    return marts.cohort_activity(fixtures.cohort_events(spark, sf_dir))


@query
def safe_rate(spark, sf_dir):
    stg = fixtures.stg(spark, sf_dir)
    counts = stg.groupBy("aid", "event_date").agg(*marts.type_counts())
    return counts.select(
        "*",
        rate("cart_count", "click_count").alias("cart_rate"),
        rate("order_count", "cart_count", 1).alias("order_rate"),
    )


# Distinct counts from stored bitmaps


def _day_bitmaps(spark: SparkSession, rows: DataFrame, id: str) -> DataFrame:
    """Bitmaps of the ids of each day, written."""
    numbers = files.scratch_table(spark, distinct.index(rows, id), "index")
    return files.scratch_table(spark, distinct.bitmaps(rows, id, numbers, ["event_date"]), "bitmaps")


def _month_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _day_bitmaps(spark, fixtures.cohort_events(spark, sf_dir), "user_id")
    return distinct.merged(days, [F.trunc("event_date", "month").alias("month")])


@query
def bitmap_cohort(spark, sf_dir):
    return distinct.cohort(_month_bitmaps(spark, sf_dir))


@query
def bitmap_cohort_size(spark, sf_dir):
    return distinct.cohort_size(_month_bitmaps(spark, sf_dir))


@query
def bitmap_distinct_sessions(spark, sf_dir):
    days = _day_bitmaps(spark, fixtures.stg(spark, sf_dir), "session_id")
    daily_counts = distinct.count(days, ["event_date"]).select(F.col("event_date").cast("string").alias("days"), "n")
    whole = distinct.count(distinct.merged(days, []))
    return daily_counts.unionByName(whole.select(F.lit("all").alias("days"), "n"))


# Profiles and display


@query
def type_stats(spark, sf_dir):
    return profile.type_stats(fixtures.stg(spark, sf_dir))


@query
def sample_stg(spark, sf_dir):
    return profile.sample(fixtures.stg(spark, sf_dir), schemas.EVENT_ORDER, 5)


@query
def kst_display(spark, sf_dir):
    shown = profile.to_display_zone(fixtures.stg(spark, sf_dir))
    return shown.select("session_id", "aid", "ts", "event_type", "event_dt", "display_dt")


@query
def user_profile_stats(spark, sf_dir):
    return profile.value_shares(
        fixtures.users(spark, sf_dir),
        ("gender", "age_group", "region", "membership"),
        {"gender": sorted(GENDERS), "age_group": list(AGE_GROUPS)},
    )


@query
def top_regions(spark, sf_dir):
    return profile.top_k(fixtures.users(spark, sf_dir), "region", 5)


# Ingestion


@query
def explode_events(spark, sf_dir):
    return ingest.explode_events(fixtures.sessions(spark, sf_dir))


@query
def normalize_types(spark, sf_dir):
    return ingest.normalize_types(ingest.explode_events(fixtures.sessions(spark, sf_dir)))


@query
def assign_users(spark, sf_dir):
    events = ingest.explode_events(fixtures.sessions(spark, sf_dir))
    assigned = ingest.assign_users(events, fixtures.users(spark, sf_dir))
    return assigned.select("session_id", "user_id").distinct()


@query
def build_events(spark, sf_dir):
    return ingest.build_events(fixtures.sessions(spark, sf_dir), fixtures.users(spark, sf_dir))


@query
def enrich_profile(spark, sf_dir):
    return ingest.enrich(fixtures.stg(spark, sf_dir), fixtures.users(spark, sf_dir))


@query
def encode_messages(spark, sf_dir):
    # The value is compared by its fields: the two JSON texts differ in white space.
    decoded = F.from_json("value", schemas.EVENT).alias("event")
    return fixtures.messages(spark, sf_dir).select("topic", "key", decoded).select(
        "topic", "key", "event.*"
    )


@query
def limit_events(spark, sf_dir):
    events = ingest.normalize_types(ingest.explode_events(fixtures.sessions(spark, sf_dir)))
    return ingest.limit_events(events, schemas.EVENT_ORDER, 5000)


@query
def raw_partition_path(spark, sf_dir):
    path = ingest.raw_path(F.col("event_type"), utc_time(F.col("ts")))
    return fixtures.raw(spark, sf_dir).select("session_id", "ts", "event_type", path.alias("path"))


# Quality


@query
def dq_checks(spark, sf_dir):
    inputs = {"raw": fixtures.raw(spark, sf_dir), "stg": fixtures.stg(spark, sf_dir)}
    checked = [
        quality.run_checks(frame).withColumn("input", F.lit(name)) for name, frame in inputs.items()
    ]
    return reduce(DataFrame.unionByName, checked)


@query
def dq_report(spark, sf_dir):
    inputs = {"raw": fixtures.raw(spark, sf_dir), "stg": fixtures.stg(spark, sf_dir)}
    reports = [
        quality.report(quality.run_checks(frame)).withColumn("input", F.lit(name))
        for name, frame in inputs.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def dq_gate(spark, sf_dir):
    return quality.gate(fixtures.stg(spark, sf_dir))


@query
def dq_type_range(spark, sf_dir):
    base = files.scratch_dir(spark, "raw-lines")
    lines = fixtures.raw_lines(spark, sf_dir)
    lines.write.partitionBy(*files.LANDING_PARTS).text(base)
    raw = files.read_raw(spark, base, ext="txt", corrupt=True)
    return quality.type_range(raw, *RANGE_MS)


@query
def schema_drift(spark, sf_dir):
    return quality.drift(fixtures.raw_lines(spark, sf_dir), "line", ["y", "m", "d"])


def _contract(frame: DataFrame, name: str) -> DataFrame:
    return quality.contract(frame, schemas.CONTRACTS[name])


@query
def contract_funnel(spark, sf_dir):
    return _contract(mart_funnel_daily(spark, sf_dir), "funnel_daily")


@query
def contract_session(spark, sf_dir):
    return _contract(mart_session(spark, sf_dir), "session")


@query
def contract_cohort(spark, sf_dir):
    return _contract(mart_cohort(spark, sf_dir), "cohort")


@query
def contract_item(spark, sf_dir):
    return _contract(mart_item_stats(spark, sf_dir), "item_stats")


@query
def contract_stg(spark, sf_dir):
    return _contract(enrich_profile(spark, sf_dir), "stg_events")


# Files


@query
def scan_raw_jsonl(spark, sf_dir):
    base = files.scratch_dir(spark, "raw")
    files.write_raw(fixtures.raw(spark, sf_dir), base, fixtures.arrival())
    return files.read_raw(spark, base, ext="json")


@query
def scan_sessions_nested(spark, sf_dir):
    path = files.scratch_dir(spark, "sessions")
    fixtures.sessions(spark, sf_dir).write.json(path)
    lines = files.read_sessions(spark, path)
    return lines.select(
        "session",
        F.size("events").cast("bigint").alias("events"),
        F.element_at("events", 1)["ts"].alias("first_ts"),
        F.element_at("events", -1)["type"].alias("last_type"),
    )


@query
def scan_users(spark, sf_dir):
    path = files.scratch_dir(spark, "users")
    files.write_users(fixtures.users(spark, sf_dir), path)
    return files.read_users(spark, path)


@query
def stg_roundtrip(spark, sf_dir):
    path = files.scratch_dir(spark, "stg")
    files.write_stg(fixtures.stg(spark, sf_dir), path)
    return files.read_stg(spark, path)


@query
def scan_stg_pruned(spark, sf_dir):
    path = files.scratch_dir(spark, "stg")
    files.write_stg(fixtures.stg(spark, sf_dir), path)
    return files.read_stg(spark, path, days=PRUNED_DAYS, types=PRUNED_TYPES)


@query
def incremental_day(spark, sf_dir):
    path = files.scratch_dir(spark, "stg")
    stg = fixtures.stg(spark, sf_dir)
    files.write_stg(stg, path)
    files.replace_day(ingest.enrich(stg, fixtures.users(spark, sf_dir)), path, REPLACED_DAY)
    return files.read_stg(spark, path)


@query
def incremental_run(spark, sf_dir):
    # A seventh of the events arrive a day late; the first arrival day is run a second time at the end.
    base, raw, users = files.scratch_dir(spark, "shop"), fixtures.raw(spark, sf_dir), fixtures.users(spark, sf_dir)
    late = F.when(F.col("ts") % 7 == 0, 1).otherwise(0)
    arrival = F.date_add(fixtures.arrival().cast("date"), late)
    first, second = (F.to_date(F.lit(d)) for d in (REPLACED_DAY, NEXT_DAY))
    daily.stage(spark, raw.filter((arrival != first) & (arrival != second)), base, users)
    for day in (first, second, first):
        stg = daily.stage(spark, raw.filter(arrival == day), base, users, merge=True)
    return stg


@query
def incremental_without_users(spark, sf_dir):
    # A day arrives once more and nobody passes the users: the stored profiles stay.
    base, raw = files.scratch_dir(spark, "shop"), fixtures.raw(spark, sf_dir)
    daily.stage(spark, raw, base, fixtures.users(spark, sf_dir))
    again = raw.filter(fixtures.arrival().cast("date") == F.to_date(F.lit(REPLACED_DAY)))
    return daily.stage(spark, again, base, merge=True)


@query
def incremental_marts(spark, sf_dir):
    # Marts of all days but one arrival day, then kept by that day's delta; a seventh of it is late.
    base, raw, users = files.scratch_dir(spark, "shop"), fixtures.raw(spark, sf_dir), fixtures.users(spark, sf_dir)
    day = F.date_add(fixtures.arrival().cast("date"), F.when(F.col("ts") % 7 == 0, 1).otherwise(0))
    held = F.to_date(F.lit(REPLACED_DAY))
    daily.run(spark, raw.filter(day != held), base, users)
    daily.run(spark, raw.filter(day == held), base, users, merge=True)
    state = daily.shop(spark, base)
    return reduce(DataFrame.unionByName, (_values(files.read_mart(spark, state, m), m) for m in MART_TABLES))


@query
def mart_roundtrip(spark, sf_dir):
    base = files.scratch_dir(spark, "mart")
    files.write_mart(mart_funnel_daily(spark, sf_dir), base, "funnel_daily")
    return files.read_mart(spark, base, "funnel_daily")


# Database


def _database(spark: SparkSession) -> tuple[str, dict[str, str]]:
    # Without a configured database: the embedded one of the Spark distribution, in the memory of
    # this process. Only a local session's tasks can see that.
    url = spark.conf.get(JDBC_URL_SETTING, None)
    if url:
        driver = spark.conf.get(JDBC_DRIVER_SETTING, None)
        return url, {"driver": driver} if driver else {}
    if not files.is_local(spark):
        raise ValueError(f"set {JDBC_URL_SETTING} to a database that all executors reach")
    memory = f"jdbc:derby:memory:clickmart{uuid.uuid4().hex};create=true"
    return memory, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@query
def jdbc_roundtrip_stg(spark, sf_dir):
    url, options = _database(spark)
    path = files.scratch_dir(spark, "stg")
    files.write_stg(fixtures.stg(spark, sf_dir), path)
    jdbc.load_stg(spark, path, url, options)
    return jdbc.read_table(spark, url, STG_TABLE, options, split="ts")


def mart_numbers(name: str) -> list[str]:
    """Number columns of a mart beside its key."""
    fields = (part.split() for part in schemas.MARTS[name].split(", "))
    return [c for c, kind in fields if kind in ("BIGINT", "DOUBLE") and c not in schemas.CONTRACTS[name].key]


def _values(table: DataFrame, name: str, created: Column | bool = True) -> DataFrame:
    """Every number of a mart by key and column."""
    key = F.concat_ws("|", *(F.col(c).cast("string") for c in schemas.CONTRACTS[name].key))
    wide = table.select(
        F.lit(name).alias("mart"), key.alias("key"), F.lit(created).alias("created"),
        *(F.col(c).cast("double") for c in mart_numbers(name)),
    )
    return wide.unpivot(["mart", "key", "created"], mart_numbers(name), "column", "value")


def _loaded_values(spark: SparkSession, url: str, options: dict[str, str], name: str) -> DataFrame:
    """Every number that the database has of a mart, and whether its load time is set."""
    table = jdbc.read_table(spark, url, MART_TABLES[name], options)
    return _values(table, name, F.col("created_at").isNotNull())


@query
def jdbc_roundtrip_marts(spark, sf_dir):
    url, options = _database(spark)
    base = files.scratch_dir(spark, "mart")
    stg = fixtures.stg(spark, sf_dir)
    for name in MART_TABLES:
        files.write_mart(marts.build(stg, name), base, name)
    jdbc.load_marts(spark, base, url, options, audit=True)
    return reduce(DataFrame.unionByName, (_loaded_values(spark, url, options, name) for name in MART_TABLES))


# Streams


def _message_stream(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    path = files.scratch_dir(spark, "messages")
    messages = fixtures.damaged_messages if damaged else fixtures.messages
    messages(spark, sf_dir).write.parquet(path)
    return spark.readStream.schema(schemas.MESSAGE).parquet(path)


@query
def stream_source_decode(spark, sf_dir):
    path = files.scratch_dir(spark, "decoded")
    decoded = streams.decode(_message_stream(spark, sf_dir), schemas.EVENT, corrupt=True)
    streams.start_append(decoded, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    schema = f"topic STRING, key STRING, {schemas.EVENT}, {files.CORRUPT} STRING"
    return spark.read.schema(schema).parquet(path)


@query
def stream_raw_landing(spark, sf_dir):
    path = files.scratch_dir(spark, "landed")
    messages = _message_stream(spark, sf_dir, damaged=True)
    streams.land_raw(messages, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    return files.read_messages(spark, path)


@query
def stream_landing_manifest(spark, sf_dir):
    path = files.scratch_dir(spark, "landed")
    messages = _message_stream(spark, sf_dir, damaged=True)
    streams.land_batches(messages, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    return files.batch_messages(spark, path)


@query
def stream_reconciled(spark, sf_dir):
    # Half of the earlier events arrive after all the others; what the watermark drops of them is brought in
    # from what has landed.
    source, path = files.scratch_dir(spark, "messages"), files.scratch_dir(spark, "cleaned")
    messages = fixtures.messages(spark, sf_dir)
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    tardy = F.coalesce((ts < sum(RANGE_MS) // 2) & (F.pmod(F.xxhash64("value"), F.lit(2)) == 1), F.lit(False))
    for part in (~tardy, tardy):
        messages.filter(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.MESSAGE).parquet(source)
        cleaned = streams.clean(streams.decode(stream), "1 day")
        streams.start_batches(cleaned, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    landed = streams.decode(spark.read.schema(schemas.MESSAGE).parquet(source))
    streamed = files.read_stg(spark, path)
    # Of copies with different profiles the first to arrive stays, so these columns are left out.
    return streamed.unionByName(streams.missed(landed, streamed)).drop(*PROFILE_COLUMNS)


@query
def stream_type_counts(spark, sf_dir):
    path = files.scratch_dir(spark, "type-counts")
    counts = streams.type_counts(streams.decode(_message_stream(spark, sf_dir)))
    streams.start_totals(counts, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    return streams.read_totals(spark, path, "event_type STRING, n BIGINT")


@query
def stream_clean(spark, sf_dir):
    path = files.scratch_dir(spark, "cleaned")
    cleaned = streams.clean(streams.decode(_message_stream(spark, sf_dir)), "60 days")
    streams.start_batches(cleaned, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    # Of copies with different profiles the first to arrive stays, so these columns are left out.
    return files.read_stg(spark, path).drop(*PROFILE_COLUMNS)


@query
def stream_session(spark, sf_dir):
    source, path = files.scratch_dir(spark, "stg"), files.scratch_dir(spark, "sessions")
    files.write_stg(fixtures.stg(spark, sf_dir), source)
    # A session's events come in several batches.
    stg = spark.readStream.schema(schemas.STG).option("maxFilesPerTrigger", 32).parquet(source)
    streams.start_sessions(stg, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    return streams.read_sessions(spark, path)


@query
def stream_funnel(spark, sf_dir):
    source, path = files.scratch_dir(spark, "stg"), files.scratch_dir(spark, "funnel")
    files.write_stg(fixtures.stg(spark, sf_dir), source)
    stg = spark.readStream.schema(schemas.STG).parquet(source)
    streams.start_totals(streams.funnel(stg), path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    return streams.read_totals(spark, path, schemas.MARTS["funnel_daily"])


# The daily run


@query
def daily_run_counts(spark, sf_dir):
    return daily.run(
        spark,
        fixtures.raw(spark, sf_dir),
        files.scratch_dir(spark, "run"),
        users=fixtures.users(spark, sf_dir),
    )

"""The steps as jobs: ``spark-submit run_job.py <job> <options>``.

Database options (user, password, driver) are read from the session's
``spark.clickmart.jdbc.<option>`` settings, object-store credentials from ``spark.hadoop.*``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

from clickmart.fixed_values import AGE_GROUPS, FLUSH_SECONDS, GENDERS
from clickmart.operators import ingest, profile, quality
from clickmart.plans import daily
from clickmart.schemas import EVENT, EVENT_ORDER, columns
from clickmart.session import configured
from clickmart.sources import files, jdbc, kafka, published
from clickmart.streaming import events as streams


def _raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.manifest:
        return files.read_batches(spark, args.raw, args.days)
    if args.landed:
        return files.read_landed(spark, args.raw, days=args.days)
    return files.read_raw(spark, args.raw, args.ext, days=args.days or ("",))


def _users(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    return files.read_users(spark, args.users, args.multiline) if args.users else None


def _database(spark: SparkSession) -> tuple[str, dict[str, str]]:
    settings = {k: spark.conf.get(f"spark.clickmart.jdbc.{k}", None)
                for k in ("url", "driver", "user", "password")}
    given = {k: v for k, v in settings.items() if v}
    if "url" not in given:
        raise ValueError("set spark.clickmart.jdbc.url")
    return given.pop("url"), given


def transform(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw zone to staging table; shows a sample and the events per type.

    With --days only these arrival days are read, and the event days they touch are replaced.
    """
    stg = daily.stage(spark, _raw(spark, args), args.base, _users(spark, args), bool(args.days))
    profile.sample(stg, EVENT_ORDER).show(truncate=False)
    profile.type_stats(stg).show()


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    """Report the checks of the staging table; fails if one does."""
    report = quality.report(quality.run_checks(files.read_stg(spark, daily.shop(spark, args.base))))
    rows = report.collect()
    for row in rows:
        print(f"{row.status}  {row.check}: {row.n}")
    if any(row.verdict == "FAIL" for row in rows):
        raise ValueError("data quality checks failed")


def marts(spark: SparkSession, args: argparse.Namespace) -> None:
    """Staging table to marts."""
    for name, table in daily.build_marts(spark, args.base).items():
        print(f"{name}: {table.count()} rows")


def load_marts(spark: SparkSession, args: argparse.Namespace) -> None:
    """Marts to the database."""
    for name, rows in jdbc.load_marts(spark, daily.shop(spark, args.base), *_database(spark)).items():
        print(f"{name}: {rows} rows")


def load_stg(spark: SparkSession, args: argparse.Namespace) -> None:
    """Staging table to the database; with --days, these days are appended."""
    url, options = _database(spark)
    rows = jdbc.load_stg(spark, daily.shop(spark, args.base), url, options, days=tuple(args.days))
    print(f"{rows} rows")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Transform (see there), check, marts and, if a database is set, its load."""
    target = (None, None)
    if spark.conf.get("spark.clickmart.jdbc.url", None):
        target = _database(spark)
    daily.run(
        spark, _raw(spark, args), args.base, _users(spark, args), *target, merge=bool(args.days)
    ).show()


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Session log to keyed messages in Kafka."""
    sessions, users = files.read_sessions(spark, args.log), _users(spark, args)
    events = ingest.normalize_types(ingest.explode_events(sessions), strict=True)
    # The limit comes before the user join, so its passes over the log do not join.
    events = ingest.limit_events(events, EVENT_ORDER, args.limit)
    events = ingest.assign_users(events, users).select(*columns(EVENT))
    messages = ingest.to_messages(events, ingest.topic_names(args.topics))
    kafka.write_messages(messages, args.servers)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    """Kafka to the raw zone, until stopped or, with --drain, until all is read."""
    topics = ingest.topic_names(args.topics).values()
    delay = f"{FLUSH_SECONDS}s" if args.least else None
    messages = kafka.read_messages(spark, args.servers, topics, args.batch, args.least, delay)
    # With --least a batch is due when it is full or the time is up, so both are looked at more often.
    often = {"processingTime": "1 second"} if args.least else streams.EVERY_FLUSH
    write = streams.land_batches if args.manifest else streams.land_raw
    write(messages, args.raw, args.checkpoint, streams.DRAIN if args.drain else often).awaitTermination()


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    """Remove folders that the last two published states do not name; not while a run is writing."""
    print(f"{published.clean(spark, args.base)} folders removed")


def user_stats(spark: SparkSession, args: argparse.Namespace) -> None:
    """Show how the users are distributed, and their most frequent regions."""
    users = _users(spark, args)
    dimensions = ("gender", "age_group", "region", "membership")
    orders = {"gender": sorted(GENDERS), "age_group": list(AGE_GROUPS)}
    shares = profile.value_shares(users, dimensions, orders).orderBy("dimension", "place")
    shares.show(shares.count())
    profile.top_k(users, "region").show()


JOBS = {
    "transform": (transform, ("raw", "base")),
    "check": (check, ("base",)),
    "marts": (marts, ("base",)),
    "load-marts": (load_marts, ("base",)),
    "load-stg": (load_stg, ("base",)),
    "run": (run, ("raw", "base")),
    "publish": (publish, ("log", "users", "servers")),
    "land": (land, ("raw", "servers", "checkpoint")),
    "clean": (clean, ("base",)),
    "user-stats": (user_stats, ("users",)),
}


def parser() -> argparse.ArgumentParser:
    """Command line of all jobs."""
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (job, required) in JOBS.items():
        sub = jobs.add_parser(name, help=job.__doc__)
        for option in ("raw", "base", "users", "log", "servers", "checkpoint"):
            sub.add_argument(f"--{option}", required=option in required)
        sub.add_argument("--days", nargs="*", default=[], help="yyyy-MM-dd")
        sub.add_argument("--ext", default="jsonl", help="extension of raw files")
        sub.add_argument("--landed", action="store_true", help="raw zone written by the land job")
        sub.add_argument("--multiline", action="store_true", help="users are one JSON array")
        sub.add_argument("--limit", type=int, default=0, help="events to publish, 0: all")
        sub.add_argument("--topics", default="shop", help="prefix of the topics")
        sub.add_argument("--batch", type=int, help="most messages per batch")
        sub.add_argument("--least", type=int, help="messages a batch waits for, a minute at most")
        sub.add_argument("--manifest", action="store_true", help="raw zone by manifest instead of the sink's log")
        sub.add_argument("--drain", action="store_true")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    """Run one job in a session with the library's settings, unless spark-submit sets others."""
    args = parser().parse_args(arguments)
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(f"clickmart-{args.job}")
        given = dict(SparkConf().getAll())
        spark = configured(builder, args.job == "land", given).getOrCreate()
    JOBS[args.job][0](spark, args)

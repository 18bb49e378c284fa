"""Files: session log, users, raw zone, staging table, marts.

Paths are any Hadoop file system URI; object-store credentials belong into the session's
``spark.hadoop.*`` settings, never into code.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas
from clickmart.fixed_values import UNKNOWN_TYPE
from clickmart.operators.ingest import CORRUPT, from_messages
from clickmart.sources import manifest, published
from clickmart.sources.published import State

LANDING_PARTS = ("et", "y", "m", "d", "h")


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in the process of the session."""
    return re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")) is not None


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting only a local session gets one, as in tests: a folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="clickmart-")
    return f"{base.rstrip('/')}/clickmart/{name}-{uuid.uuid4().hex}"


def scratch_table(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in a scratch folder."""
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_batches(spark: SparkSession, path: str, before: int) -> None:
    """Remove the folders ``batch=<id>`` of ``path`` with a smaller id."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in system.listStatus(place):
        name = folder.getPath().getName()
        if name.startswith("batch=") and int(name.removeprefix("batch=")) < before:
            system.delete(folder.getPath(), True)


# Session log and users


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Session log, one JSON object per line."""
    return spark.read.schema(schemas.SESSION_LOG).json(path)


def read_users(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """User dimension: JSON lines (objects or arrays of objects), read by many tasks.

    ``multiline`` reads files that are one pretty-printed array each; such a file cannot be split.
    """
    return spark.read.schema(schemas.USERS).option("multiLine", multiline).json(path)


def write_users(users: DataFrame, path: str) -> None:
    """User dimension as JSON lines."""
    users.select(*schemas.columns(schemas.USERS)).write.mode("overwrite").json(path)


# Raw zone


def landing_parts(event_type: Column, arrival: Column) -> list[Column]:
    """Folder levels of the raw zone: a copy of the type (the record keeps its own) and the
    zero-padded year, month, day and hour of arrival (zone-less UTC)."""
    text = arrival.cast("string")
    pieces = [F.substring(text, 1, 4), *(F.substring(text, at, 2) for at in (6, 9, 12))]
    kind = F.coalesce(event_type, F.lit(UNKNOWN_TYPE))
    return [c.alias(n) for c, n in zip([kind, *pieces], LANDING_PARTS, strict=True)]


def write_raw(events: DataFrame, base: str, arrival: Column) -> None:
    """Land events as JSON lines by type and arrival hour."""
    parts = landing_parts(F.col("event_type"), arrival)
    # Without the rebalance every input partition would write a file into every folder.
    landed = events.select("*", *parts).hint("rebalance", *LANDING_PARTS)
    landed.write.mode("overwrite").partitionBy(*LANDING_PARTS).json(base)


def read_raw(
    spark: SparkSession,
    base: str,
    ext: str = "jsonl",
    types: Sequence[str] = ("",),
    days: Sequence[str] = ("",),
    corrupt: bool = False,
) -> DataFrame:
    """Raw events from ``base/type/year/month/day/hour/*.ext`` with the fixed raw schema.

    ``types`` and ``days`` (``yyyy-MM-dd``) restrict the folders that are listed at all. Level names
    may be bare (``click/2024``) or Hive-style (``et=click/y=2024``). Unreadable fields become
    NULL; with ``corrupt`` the text of such lines is kept in ``_corrupt_record``.
    """
    globs = [
        f"{base.rstrip('/')}/*{kind}/{'/'.join('*' + p for p in day.split('-')) if day else '*/*/*'}"
        f"/*/*.{ext}"
        for kind in types
        for day in days
    ]
    schema = f"{schemas.RAW}, {CORRUPT} STRING" if corrupt else schemas.RAW
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(globs)


def read_landed(
    spark: SparkSession,
    base: str,
    types: Sequence[str] = (),
    days: Sequence[str] = (),
    corrupt: bool = False,
) -> DataFrame:
    """Raw events of the messages that a landing stream has committed to ``base``.

    With ``corrupt``, a message that could not be read whole is kept in ``_corrupt_record``.

    Reading the folder as a whole goes through the sink's log, so files of failed attempts do not
    count; ``types`` and ``days`` prune folders.
    """
    landed = read_messages(spark, base, types, days)
    names = [*schemas.columns(schemas.RAW), *([CORRUPT] if corrupt else [])]
    return from_messages(landed, schemas.RAW, corrupt).select(*names)


def read_messages(
    spark: SparkSession, base: str, types: Sequence[str] = (), days: Sequence[str] = ()
) -> DataFrame:
    """Landed messages as they were delivered: ``topic``, ``key``, ``value``."""
    parts = ", ".join(f"{name} STRING" for name in LANDING_PARTS)
    landed = spark.read.schema(f"{schemas.MESSAGE}, {parts}").json(base)
    if types:
        landed = landed.filter(F.col("et").isin(*types))
    if days:
        landed = landed.filter(F.concat_ws("-", "y", "m", "d").isin(*days))
    return landed.select(*schemas.columns(schemas.MESSAGE))


def read_batches(
    spark: SparkSession, base: str, days: Sequence[str] = (), types: Sequence[str] = (), corrupt: bool = False
) -> DataFrame:
    """Raw events of the batches that a manifest names; of other days (``yyyy-MM-dd``) nothing is listed."""
    names = [*schemas.columns(schemas.RAW), *([CORRUPT] if corrupt else [])]
    return from_messages(batch_messages(spark, base, days, types), schemas.RAW, corrupt).select(*names)


def batch_messages(
    spark: SparkSession, base: str, days: Sequence[str] = (), types: Sequence[str] = ()
) -> DataFrame:
    """Messages as they were delivered, of the batches that a manifest names."""
    folders = [f"{base.rstrip('/')}/{folder}" for folder in manifest.whole(spark, base, days)]
    if not folders:
        return spark.createDataFrame([], schemas.MESSAGE)
    landed = spark.read.schema(f"{schemas.MESSAGE}, et STRING").option("basePath", base).json(folders)
    if types:
        landed = landed.filter(F.col("et").isin(*types))
    return landed.select(*schemas.columns(schemas.MESSAGE))


# Staging table


def read_stg(
    spark: SparkSession, source: str | State, days: Sequence[str] = (), types: Sequence[str] = ()
) -> DataFrame:
    """Staging table in a folder or of a published state; ``days`` and ``types`` prune its partitions.

    The schema is given, so an empty table reads as one without rows. Of a published state, the folders
    of other days are not even listed.
    """
    if isinstance(source, State):
        stg = published.read(spark, source, "stg", schemas.STG, [f"event_date={d}" for d in days] if days else None)
    else:
        stg = spark.read.schema(schemas.STG).parquet(source).select(*schemas.columns(schemas.STG))
    if days:
        stg = stg.filter(F.col("event_date").isin(*(F.to_date(F.lit(d)) for d in days)))
    if types:
        stg = stg.filter(F.col("event_type").isin(*types))
    return stg


def write_stg(stg: DataFrame, path: str) -> None:
    """Replace the staging table, partitioned by day and type.

    The rebalance gathers each partition's rows into few files; adaptive execution splits a large
    (day, type) over many tasks and joins small ones.
    """
    balanced = stg.hint("rebalance", *schemas.STG_PARTITIONS)
    balanced.write.mode("overwrite").partitionBy(*schemas.STG_PARTITIONS).parquet(path)


def replace_day(stg: DataFrame, path: str, day: str) -> None:
    """Replace one day (``yyyy-MM-dd``) of the staging table and leave the others alone.

    The day's folder is overwritten as a whole, so a type that no longer occurs goes away too.
    """
    rows = stg.filter(F.col("event_date") == F.to_date(F.lit(day))).drop("event_date")
    balanced = rows.hint("rebalance", "event_type")
    folder = f"{path.rstrip('/')}/event_date={day}"
    balanced.write.mode("overwrite").partitionBy("event_type").parquet(folder)


# Marts


def write_mart(mart: DataFrame, base: str, name: str) -> None:
    """Replace a mart."""
    mart.write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}")


def read_mart(spark: SparkSession, source: str | State, name: str) -> DataFrame:
    """A mart by name, in a folder or of a published state."""
    if isinstance(source, State):
        return published.read(spark, source, name, schemas.MARTS[name])
    base = source
    return spark.read.schema(schemas.MARTS[name]).parquet(f"{base.rstrip('/')}/{name}")

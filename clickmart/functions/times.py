"""Event times. All of them are zone-less UTC times, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 0001-01-01 to 9999-12-31 in epoch milliseconds; a time outside is unusable and becomes NULL
# rather than failing the whole job on overflow.
FIRST_MS = -62_135_596_800_000
LAST_MS = 253_402_300_799_999


def utc_time(ms: Column) -> Column:
    """UTC time of epoch milliseconds, cut toward zero to whole seconds."""
    seconds = F.call_function("div", ms, F.lit(1000))
    time = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.expr("INTERVAL '1' SECOND") * seconds
    return F.when(ms.between(FIRST_MS, LAST_MS), time)


def epoch_ms(time: Column) -> Column:
    """Epoch milliseconds of a zone-less UTC time, cut to whole milliseconds."""
    since = (time - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")).cast("interval second")
    return F.floor(since.cast("decimal(20,6)") * 1000).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from one zone-less time to another."""
    return (end - start).cast("interval second").cast("bigint")


def month(day: Column) -> Column:
    """``yyyy-MM`` of a date."""
    return F.left(day.cast("string"), F.lit(7))


def hour_path(time: Column) -> Column:
    """``yyyy/MM/dd/HH`` of a zone-less time."""
    return F.translate(F.left(time.cast("string"), F.lit(13)), "- ", "//")


def in_zone(time: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a zone-less UTC time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), time)

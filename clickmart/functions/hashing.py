"""Deterministic draws: the same key gets the same value in every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_number(text: Column, digits: int = 8) -> Column:
    """The first hex ``digits`` (up to 15) of the text's MD5 as a number."""
    return F.conv(F.left(F.md5(text.cast("string")), F.lit(digits)), 16, 10).cast("bigint")

"""Joins of events to a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 1000


def join_dimension(
    facts: DataFrame, dimension: DataFrame, on: str, how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Equi-join of ``facts`` to a ``dimension`` with unique ``on``.

    Spark picks the strategy: it broadcasts a dimension below its threshold, and otherwise adaptive
    execution splits the partitions of hot keys, however many there are. Facts without a key match
    nothing, so they are spread over ``salts`` values; the salt is a hash of the fact itself, hence
    the same when a lost task is run again.
    """
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    salted = facts.withColumn("_salt", F.when(F.col(on).isNull(), spread).otherwise(0))
    return salted.join(dimension.withColumn("_salt", F.lit(0)), [on, "_salt"], how).drop("_salt")

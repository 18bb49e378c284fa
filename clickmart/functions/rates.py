"""Ratios in percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(_col(part), _col(whole)) * 100, digits)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value

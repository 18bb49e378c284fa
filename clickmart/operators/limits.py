"""The first rows of a large table."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1000
NUMBERS = ("int", "bigint")


def first_rows(frame: DataFrame, order: Sequence[str], n: int, steps: int = STEPS) -> DataFrame:
    """The first ``n`` rows in ``order``, NULLs first.

    A plain top-n takes ``n`` rows of every input partition into one task. Here the rows behind a
    cut-off are filtered out before, so that task gets little more than ``n`` rows.
    """
    return frame.filter(_not_behind(frame, order, n, steps)).orderBy(*order).limit(n)


def _rising(frame: DataFrame, name: str) -> tuple[Column | None, bool]:
    """An integer that is never smaller for a later value of the column, and whether different values
    always differ in it; None for types without one.

    Times count in seconds; texts by their first seven bytes, which is how Spark compares texts.
    """
    kind, column = dict(frame.dtypes)[name], F.col(name)
    if kind in NUMBERS:
        return column, True
    if kind == "date":
        return F.unix_date(column).cast("bigint"), True
    if kind == "timestamp":
        return F.unix_seconds(column), False
    if kind == "timestamp_ntz":
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        return F.unix_date(column.cast("date")).cast("bigint") * 86400 + seconds, False
    if kind == "string":
        start = F.hex(F.substring(column.cast("binary"), 1, 7))
        return F.conv(F.rpad(start, 14, "0"), 16, 10).cast("bigint"), False
    return None, False


def _not_behind(frame: DataFrame, order: Sequence[str], n: int, steps: int) -> Column:
    """A condition that the first ``n`` rows meet, and at most about ``n`` others.

    The column's range is counted in ``steps`` parts, then the part with the n-th row again, and so
    on. If one value alone has more than ``n`` rows, they are cut by the next column. Each pass
    reads the columns needed and returns ``steps`` counts. Texts and times are counted by a number
    that goes up with them (see ``_rising``).
    """
    column, exact = _rising(frame, order[0]) if order else (None, False)
    if column is None:
        return F.lit(True)
    nulls, low, high = frame.agg(F.count_if(column.isNull()), F.min(column), F.max(column)).first()
    before, size = nulls, n + 1
    if low is None or before >= n:
        return column.isNull() if before >= n else F.lit(True)
    while size > n and low < high:
        width = -(-(high - low + 1) // steps)
        # Both ends of a bigint range together do not fit a bigint.
        part = F.call_function("div", column.cast("decimal(20,0)") - F.lit(Decimal(low)), F.lit(Decimal(width)))
        inside = frame.filter(column.between(low, high)).groupBy(part.alias("part"))
        counts = sorted((r["part"], r["count"]) for r in inside.count().collect())
        for place, size in counts:
            if before + size >= n:
                break
            before += size
        else:
            return F.lit(True)
        low, high = low + place * width, min(high, low + (place + 1) * width - 1)
    earlier = column.isNull() | (column <= high)
    if size <= n or not exact:
        return earlier
    ties = _not_behind(frame.filter(column == high), order[1:], n - before, steps)
    return column.isNull() | (column < high) | ((column == high) & ties)

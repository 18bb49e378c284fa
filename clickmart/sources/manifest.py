"""Which landed batches are whole: one small marker file per batch, by day of arrival.

A marker is written after the files of its batch, and its name says in which folder they are. A reader of some days lists these
days' markers and no data folder of another day; no log grows with the age of the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from clickmart.sources import folders

MARKERS = "_manifest"


def new_folder(batch_id: int, now: datetime | None = None) -> str:
    """A new folder for an attempt at a batch that arrives now (UTC)."""
    now = now or datetime.now(timezone.utc)
    return f"day={now:%Y-%m-%d}/hour={now:%H}/batch={batch_id}-{uuid.uuid4().hex[:8]}"


def _top(base: str) -> str:
    return f"{base.rstrip('/')}/{MARKERS}"


def add(spark: SparkSession, base: str, folder: str) -> None:
    """Make a batch's folder visible: one empty marker, whose name says all, so it is never half written."""
    day, hour, batch = (level.split("=", 1)[1] for level in folder.split("/"))
    place, system = folders.place(spark, f"{_top(base)}/{day}/{hour}.{batch}")
    system.create(place).close()


def find(spark: SparkSession, base: str, batch_id: int) -> str | None:
    """The folder of a batch that is whole. Only a stream's last batch is ever tried again, so its marker, if there
    is one, is on the last day that has any."""
    for found in whole(spark, base, folders.names(spark, _top(base))[-1:] or [""]):
        if found.rsplit("batch=", 1)[1].split("-")[0] == str(batch_id):
            return found
    return None


def whole(spark: SparkSession, base: str, days: Sequence[str] = ()) -> list[str]:
    """Folders of whole batches that arrived on the days, or on any."""
    out = []
    for day in days or folders.names(spark, _top(base)):
        for name in folders.names(spark, f"{_top(base)}/{day}"):
            if name[0] in "._":
                continue
            hour, batch = name.split(".", 1)
            out.append(f"day={day}/hour={hour}/batch={batch}")
    return out

"""Streams in several micro-batches, with restarts, against the batch results."""

from __future__ import annotations

from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_clean import raw
from test_ingest import same

from clickmart import schemas
from clickmart.fixed_values import PROFILE_COLUMNS
from clickmart.operators import clean, ingest, marts
from clickmart.plans import fixtures
from clickmart.session import STREAM_SETTINGS
from clickmart.sources import files
from clickmart.streaming import events as streams

DAY = 86_400_000


class Feed:
    """Messages appended to a folder, one file per call, read one file per micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.path = spark, f"{folder}/messages"
        self.folder = folder

    def add(self, events):
        ingest.to_messages(events).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, schema=schemas.RAW):
        reader = self.spark.readStream.schema(schemas.MESSAGE).option("maxFilesPerTrigger", 1)
        return streams.decode(reader.parquet(self.path), schema)

    def clean(self, delay="10 days"):
        query = streams.start_batches(
            streams.clean(self.stream(), delay),
            f"{self.folder}/out", f"{self.folder}/offsets", streams.DRAIN,
        )
        query.awaitTermination()
        return files.read_stg(self.spark, f"{self.folder}/out")

    def land(self):
        reader = self.spark.readStream.schema(schemas.MESSAGE).option("maxFilesPerTrigger", 1)
        query = streams.land_raw(
            reader.parquet(self.path), f"{self.folder}/landed", f"{self.folder}/offsets", streams.DRAIN
        )
        query.awaitTermination()
        return files.read_landed(self.spark, f"{self.folder}/landed")


@pytest.fixture
def feed(spark, tmp_path):
    yield Feed(spark, str(tmp_path))
    spark.catalog.clearCache()


def test_decoding_survives_values_that_are_no_json(spark):
    frame = spark.createDataFrame(
        [("t", "k", '{"session_id":1,"aid":2,"ts":3,"event_type":"click","user_id":"u"}'),
         ("t", None, "no json"), ("t", "k", None)],
        schemas.MESSAGE,
    )
    rows = [tuple(r) for r in streams.decode(frame, schemas.EVENT).collect()]
    assert rows[0] == ("t", "k", 1, 2, 3, "click", "u")
    assert rows[1] == ("t", None, *[None] * 5) and rows[2] == ("t", "k", *[None] * 5)


def test_landing_is_exactly_once_over_restarts(spark, sf_dir, feed):
    first, second = fixtures.raw(spark, sf_dir).randomSplit([0.7, 0.3], seed=1)
    first, second = first.cache(), second.cache()
    feed.add(first)
    assert same(feed.land(), first)
    assert same(feed.land(), first)
    feed.add(second)
    assert same(feed.land(), first.unionAll(second))


def test_landing_uses_the_arrival_hour_and_a_place_for_missing_types(spark, feed):
    feed.add(raw(spark, (1, 1, 0, "click", "u"), (2, 1, 0, None, "u")))
    start = datetime.now(timezone.utc)
    feed.land()
    hours = {start.strftime("%Y-%m-%d"), datetime.now(timezone.utc).strftime("%Y-%m-%d")}
    landed = f"{feed.folder}/landed"
    assert files.read_landed(spark, landed, days=sorted(hours)).count() == 2
    missing = files.read_landed(spark, landed, types=["unknown"]).collect()
    assert [(r.session_id, r.event_type) for r in missing] == [(2, None)]


def test_streamed_cleaning_equals_the_batch(spark, sf_dir, feed):
    everything = fixtures.raw(spark, sf_dir).cache()
    for part in everything.randomSplit([1.0] * 4, seed=2):
        feed.add(part)
    profile = list(PROFILE_COLUMNS)
    assert same(feed.clean("60 days").drop(*profile), clean.transform(everything).drop(*profile))


def test_copies_in_other_batches_and_after_restarts_are_removed(spark, feed):
    event, other = (1, 1, DAY, "click", "u"), (2, 1, DAY, "order", "u")
    feed.add(raw(spark, event, event))
    feed.add(raw(spark, event, other))
    assert sorted(r.session_id for r in feed.clean().collect()) == [1, 2]
    feed.add(raw(spark, event, other, (3, 1, DAY, "cart", "u")))
    assert sorted(r.session_id for r in feed.clean().collect()) == [1, 2, 3]


def test_cleaning_keeps_its_state_on_disk_with_the_stream_settings(spark, feed):
    provider = "spark.sql.streaming.stateStore.providerClass"
    changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    for key in (provider, changelog):
        spark.conf.set(key, STREAM_SETTINGS[key])
    try:
        event = (1, 1, DAY, "click", "u")
        feed.add(raw(spark, event))
        feed.add(raw(spark, event, (2, 1, DAY, "cart", "u")))
        assert sorted(r.session_id for r in feed.clean().collect()) == [1, 2]
        feed.add(raw(spark, event))
        assert feed.clean().count() == 2
    finally:
        spark.conf.unset(provider)
        spark.conf.unset(changelog)


def test_a_time_in_the_future_does_not_make_others_late(spark, feed):
    feed.add(raw(spark, (1, 1, 4_000_000_000_000, "click", "u"), (2, 1, 2**62, "click", "u")))
    feed.add(raw(spark, (3, 1, DAY, "click", "u")))
    feed.add(raw(spark, (1, 1, 4_000_000_000_000, "click", "u"), (4, 1, 2 * DAY, "click", "u")))
    got = {r.session_id: r.event_dt for r in feed.clean().collect()}
    assert set(got) == {3, 4}
    ahead = streams.unsound(streams.decode(spark.read.schema(schemas.MESSAGE).parquet(feed.path)))
    assert sorted(r.session_id for r in ahead.collect()) == [1, 1, 2]


def test_the_first_copy_does_not_depend_on_the_clock(spark, feed, monkeypatch):
    event = (1, 1, DAY, "click", "u")
    feed.add(raw(spark, event))
    assert feed.clean().count() == 1
    # The clock steps back to the time of the events: a copy that comes now is still a copy.
    monkeypatch.setattr(streams, "_sound", lambda: F.col("ts").between(F.lit(0), F.lit(2 * DAY)))
    feed.add(raw(spark, event, (2, 1, 2 * DAY, "cart", "u")))
    assert sorted(r.session_id for r in feed.clean().collect()) == [1, 2]


def test_batches_have_few_files_and_are_pruned(spark, sf_dir, feed):
    feed.add(fixtures.raw(spark, sf_dir))
    cleaned = feed.clean("60 days")
    pairs = cleaned.select("event_date", "event_type").distinct().count()
    assert len(list(Path(feed.folder, "out").rglob("*.parquet"))) <= 2 * pairs
    one = files.read_stg(spark, f"{feed.folder}/out", days=["2024-01-10"], types=["cart"])
    assert one.count() == cleaned.filter("event_date = date'2024-01-10' and event_type = 'cart'").count() > 0


def test_landing_keeps_messages_verbatim(spark, feed):
    values = ["broken {", '{"campaign":"x","session_id":1,"aid":2,"ts":3,"event_type":"click","user_id":"u"}',
              '{"session_id":1,"aid":2.5,"ts":3,"event_type":"cart","user_id":"u"}', "two\nlines", None]
    frame = spark.createDataFrame([("t", f"k{i}", v) for i, v in enumerate(values)], schemas.MESSAGE)
    frame.coalesce(1).write.parquet(feed.path)
    feed.land()
    landed = f"{feed.folder}/landed"
    assert {r.key: r.value for r in files.read_messages(spark, landed).collect()} == {
        f"k{i}": v for i, v in enumerate(values)
    }
    assert [r.value for r in files.read_messages(spark, landed, types=["cart"]).collect()] == [values[2]]
    rows = files.read_landed(spark, landed, corrupt=True).collect()
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted([values[0], values[2], values[3]])


def test_a_stream_runs_batch_after_batch(spark, feed):
    feed.add(raw(spark, (1, 1, DAY, "click", "u")))
    query = streams.start_batches(
        streams.clean(feed.stream(), "10 days"), f"{feed.folder}/out", f"{feed.folder}/offsets",
        {"processingTime": "1 second"},
    )
    try:
        query.processAllAvailable()
        feed.add(raw(spark, (2, 1, DAY, "cart", "u")))
        query.processAllAvailable()
        assert files.read_stg(spark, f"{feed.folder}/out").count() == 2
        assert query.isActive
    finally:
        query.stop()


def test_events_beyond_the_delay_are_left_to_the_batch_job(spark, feed):
    feed.add(raw(spark, (1, 1, 100 * DAY, "click", "u")))
    feed.add(raw(spark, (2, 1, 95 * DAY, "click", "u")))
    feed.clean("10 days")
    feed.add(raw(spark, (3, 1, 92 * DAY, "click", "u"), (4, 1, 10 * DAY, "click", "u")))
    assert sorted(r.session_id for r in feed.clean("10 days").collect()) == [1, 2, 3]


def test_running_totals_and_funnel_follow_the_stream(spark, sf_dir, feed):
    everything = fixtures.raw(spark, sf_dir).cache()
    for n, part in enumerate(everything.randomSplit([1.0] * 3, seed=3)):
        feed.add(part)
        path = f"{feed.folder}/totals"
        streams.start_totals(
            streams.type_counts(feed.stream()), path, f"{path}-offsets", streams.DRAIN
        ).awaitTermination()
    totals = streams.read_totals(spark, path, "event_type STRING, n BIGINT")
    assert len(list(Path(path).glob("batch=*"))) <= 2
    assert same(totals, everything.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


def test_streamed_funnel_equals_the_mart(spark, sf_dir, tmp_path):
    stg = fixtures.stg(spark, sf_dir)
    files.write_stg(stg, f"{tmp_path}/stg")
    reader = spark.readStream.schema(schemas.STG).option("maxFilesPerTrigger", 30)
    query = streams.start_totals(
        streams.funnel(reader.parquet(f"{tmp_path}/stg")),
        f"{tmp_path}/out", f"{tmp_path}/offsets", streams.DRAIN,
    )
    query.awaitTermination()
    funnel = streams.read_totals(spark, f"{tmp_path}/out", schemas.MARTS["funnel_daily"])
    assert same(funnel, marts.build(stg, "funnel_daily"))
    assert streams.events_per_second(query) is not None

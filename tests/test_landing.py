"""Landing with a manifest, late events, triggers, and the options that reach the message source."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from test_ingest import same

from clickmart import schemas
from clickmart.operators import clean, ingest
from clickmart.plans import daily, fixtures
from clickmart.sources import files, kafka, manifest
from clickmart.streaming import events as streams

DAY = 86_400_000


def message(session, ts, kind="click", user="u"):
    value = {"session_id": session, "aid": 1, "ts": ts, "event_type": kind, "user_id": user}
    return ("shop.clicks", user, json.dumps(value))


def put(spark, path, *rows):
    spark.createDataFrame(rows, schemas.MESSAGE).coalesce(1).write.mode("append").parquet(path)


def land(spark, source, base, trigger=streams.DRAIN):
    stream = spark.readStream.schema(schemas.MESSAGE).parquet(source)
    query = streams.land_batches(stream, base, f"{base}-offsets", trigger)
    query.awaitTermination()
    return query


def test_batches_are_read_by_their_manifest(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "raw")
    put(spark, source, message(1, 5), message(2, 6, "cart"), ("shop.x", None, "no json {"))
    land(spark, source, base)
    put(spark, source, message(3, 7, "order"))
    land(spark, source, base)
    rows = files.batch_messages(spark, base)
    assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, spark.read.parquet(source).collect()))
    assert [r.session_id for r in files.read_batches(spark, base, types=["cart"]).collect()] == [2]
    events = files.read_batches(spark, base, corrupt=True)
    assert [r[files.CORRUPT] for r in events.filter(f"{files.CORRUPT} IS NOT NULL").collect()] == ["no json {"]
    # A folder without a marker is a broken attempt.
    put(spark, source, message(9, 9))
    spark.read.parquet(source).withColumn("et", F.lit("x")).write.partitionBy("et").json(f"{base}/{manifest.new_folder(7)}")
    assert files.batch_messages(spark, base).count() == 4
    assert files.batch_messages(spark, base, days=["1999-01-01"]).collect() == []


def test_a_day_touches_its_own_files(spark, tmp_path):
    base, days = str(tmp_path / "raw"), ("2024-01-14", "2024-01-15")
    for n, day in enumerate(days):
        folder = manifest.new_folder(n, datetime.fromisoformat(f"{day}T09:30:00").replace(tzinfo=timezone.utc))
        rows = spark.createDataFrame([(*message(n, 5), "click")], f"{schemas.MESSAGE}, et string")
        rows.write.partitionBy("et").json(f"{base}/{folder}")
        manifest.add(spark, base, folder)
    found = files.read_batches(spark, base, days=days[1:])
    assert [r.session_id for r in found.collect()] == [1]
    assert all("day=2024-01-15/hour=09" in f for f in found.inputFiles())
    assert manifest.find(spark, base, 1) and not manifest.find(spark, base, 0)


def test_a_batch_that_is_tried_again_lands_once(spark, tmp_path, monkeypatch):
    source, base = str(tmp_path / "in"), str(tmp_path / "raw")
    put(spark, source, message(1, 5))

    def broken(*args, plain=manifest.add, after):
        if after:
            plain(*args)
        raise OSError("lost")

    for after in (False, True):
        with monkeypatch.context() as patched:
            patched.setattr(manifest, "add", lambda *a, after=after: broken(*a, after=after))
            with pytest.raises(Exception, match="lost"):
                land(spark, source, base)
    land(spark, source, base)
    assert files.batch_messages(spark, base).count() == 1


def test_landing_by_time_in_two_batches_and_its_rate(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "raw")
    put(spark, source, message(1, 5))
    stream = spark.readStream.schema(schemas.MESSAGE).parquet(source)
    query = streams.land_batches(stream, base, f"{base}-offsets", {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        put(spark, source, message(2, 6), message(3, 6))
        query.processAllAvailable()
        rates = [p["processedRowsPerSecond"] for p in query.recentProgress if p["numInputRows"]]
        assert len(rates) == 2 and all(r > 0 for r in rates)
        assert streams.events_per_second(query) is not None
    finally:
        query.stop()
    assert files.batch_messages(spark, base).count() == 3 and len(manifest.whole(spark, base)) == 2


def test_what_the_watermark_dropped_reaches_its_day(spark, tmp_path):
    """Stream and reconciliation together hold every event, and the published table equals a batch run."""
    source, path, base = (str(tmp_path / x) for x in ("in", "cleaned", "shop"))
    batches = [[message(1, 9 * DAY), message(2, 9 * DAY + 1)], [message(1, 9 * DAY), message(3, DAY), message(4, 9 * DAY)],
               [message(3, DAY), message(5, 20 * DAY), message(6, 2 * DAY)]]
    for rows in batches:
        put(spark, source, *rows)
        stream = spark.readStream.schema(schemas.MESSAGE).parquet(source)
        cleaned = streams.clean(streams.decode(stream), "1 hour")
        streams.start_batches(cleaned, path, f"{path}-offsets", streams.DRAIN).awaitTermination()
    landed = streams.decode(spark.read.schema(schemas.MESSAGE).parquet(source)).select(*schemas.columns(schemas.RAW))
    streamed = files.read_stg(spark, path)
    late = streams.missed(landed, streamed)
    assert sorted(r.session_id for r in late.collect()) == [3, 6]
    daily.stage(spark, streamed.select(*schemas.columns(schemas.RAW)), base)
    daily.stage(spark, late.select(*schemas.columns(schemas.RAW)), base, merge=True)
    assert same(files.read_stg(spark, daily.shop(spark, base)), clean.transform(landed))


def test_options_of_the_message_source_and_sink(spark, monkeypatch):
    asked = {}

    def reader_option(self, key, value):
        asked[key] = value
        return self

    def load(self, *args):
        one = spark.createDataFrame([(b"u", b"{}", "shop.clicks", 0, 5)], "key binary, value binary, topic string, partition int, offset long")
        return one

    monkeypatch.setattr(DataStreamReader, "format", lambda self, f: reader_option(self, "format", f))
    monkeypatch.setattr(DataStreamReader, "option", reader_option)
    monkeypatch.setattr(DataStreamReader, "load", load)
    topics = ingest.topic_names().values()
    found = kafka.read_messages(spark, "a:1,b:2", topics, max_messages=10, min_messages=5, max_delay="1m")
    assert asked == {
        "format": "kafka", "kafka.bootstrap.servers": "a:1,b:2", "subscribe": ",".join(topics), "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 10, "minOffsetsPerTrigger": 5, "maxTriggerDelay": "1m",
    }
    assert found.dtypes == [("topic", "string"), ("key", "string"), ("value", "string")]
    assert found.first() == ("shop.clicks", "u", "{}")
    asked.clear()
    kafka.read_messages(spark, "a:1", ["t"])
    assert set(asked) == {"format", "kafka.bootstrap.servers", "subscribe", "startingOffsets"}

    sent = {}
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, f: sent.update(format=f) or self)
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: sent.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: sent.update({k: v}) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: sent.update(columns=self._df.columns))
    kafka.write_messages(spark.createDataFrame([message(1, 5)], schemas.MESSAGE), "a:1")
    assert sent == {**kafka.PRODUCER_OPTIONS, "format": "kafka", "kafka.bootstrap.servers": "a:1", "columns": ["topic", "key", "value"]}


def test_tables_in_another_file_system(spark, sf_dir, tmp_path):
    """A mounted file system that only Hadoop's readers open: staging, states, marts, and the raw zone."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shop.link./data", f"file://{tmp_path}")
    base = "viewfs://shop/data/base"
    events, users = fixtures.raw(spark, sf_dir), fixtures.users(spark, sf_dir)
    files.write_raw(events, f"{base}/raw", fixtures.arrival())
    daily.run(spark, files.read_raw(spark, f"{base}/raw", ext="json"), base, users)
    assert same(files.read_stg(spark, daily.shop(spark, base)), ingest.enrich(clean.transform(events), users))
    assert (tmp_path / "base/_published").exists()

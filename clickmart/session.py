"""Session settings for a cluster. The library itself neither builds nor changes a session."""

from __future__ import annotations

from collections.abc import Container

from pyspark.sql import SparkSession

COMMON_SETTINGS = {
    # Columns are built without a record of the calling line: half the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A leaving executor hands its shuffle files on.
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}

BATCH_SETTINGS = {
    # Plans are corrected at run time: skewed joins and rebalanced partitions are split, small
    # partitions joined.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Shuffles start with many small partitions and are coalesced to the advisory size.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
}

STREAM_SETTINGS = {
    # The number of state partitions; it stays what it was when the checkpoint was made.
    "spark.sql.shuffle.partitions": "1000",
    # State on local disk instead of the heap; the changes of each batch go to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configured(
    builder: SparkSession.Builder, streaming: bool = False, given: Container[str] = ()
) -> SparkSession.Builder:
    """``builder`` with the settings for batch jobs, or for streams, but for those that are ``given``."""
    settings = COMMON_SETTINGS | (STREAM_SETTINGS if streaming else BATCH_SETTINGS)
    for key, value in settings.items():
        if key in given:
            continue
        builder = builder.config(key, value)
    return builder

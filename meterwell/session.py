"""Session settings for cluster runs, as plain dictionaries for a builder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Batch: let adaptive execution size, merge and split shuffle partitions. The
# initial number is an upper bound that adaptive execution merges down from.
BATCH = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}

# Stream: one state store per shuffle partition and micro-batch, so the number
# follows windows x regions and not the event volume. State is on disk.
STREAM = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for one stream, with no more state stores than cores to run them.

    A stream keeps the partition number it first ran with, and the state here is
    small, so the batch session's number would only add empty stores per batch.
    """
    own = spark.newSession()
    for key, value in STREAM.items():
        own.conf.set(key, value)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    stores = min(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    own.conf.set("spark.sql.shuffle.partitions", str(stores))
    return own

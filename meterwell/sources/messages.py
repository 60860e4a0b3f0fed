"""Event and alert messages: JSON line files and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.streaming import DataStreamWriter

from meterwell.operators.events import decode_events, event_json, event_messages
from meterwell.schemas import USAGE_EVENT

# Topic names of the producers and the alert consumers.
EVENT_TOPIC = "customer_usage_events"
ALERT_TOPIC = "churn_risk_alert"


def write_event_files(events: DataFrame, path: str) -> str:
    """Events as JSON lines, one object per line, replacing the folder."""
    events.select(event_json(events).alias("value")).write.mode("overwrite").text(path)
    return path


def append_event_files(events: DataFrame, path: str) -> str:
    """More events for a stream that already watches the folder."""
    events.select(event_json(events).alias("value")).write.mode("append").text(path)
    return path


def read_event_files(
    spark: SparkSession, path: str, schema: t.StructType = USAGE_EVENT
) -> DataFrame:
    """Decoded events with a `_corrupt_record` column."""
    return decode_events(spark.read.text(path), schema)


def stream_event_files(
    spark: SparkSession,
    path: str,
    schema: t.StructType = USAGE_EVENT,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """The same rows as a stream of the files that appear in a folder."""
    reader = spark.readStream
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return decode_events(reader.text(path), schema)


def stream_event_topic(
    spark: SparkSession,
    servers: str,
    topic: str = EVENT_TOPIC,
    schema: t.StructType = USAGE_EVENT,
    starting: str = "latest",
) -> DataFrame:
    """The same rows from a topic. Needs Spark's Kafka connector on the class path."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    return decode_events(messages, schema)


# Delivery settings of the event producer.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.linger.ms": "5",
    "kafka.batch.size": str(1000 * 1024),
    "kafka.compression.type": "gzip",
}


def write_event_topic(events: DataFrame, servers: str, topic: str = EVENT_TOPIC) -> None:
    """Keyed JSON messages to a topic. Needs Spark's Kafka connector."""
    (
        event_messages(events)
        .write.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as messages keyed by region."""
    return alerts.select(F.col("circle_id").alias("key"), event_json(alerts).alias("value"))


def alert_topic_writer(
    alerts: DataFrame, servers: str, checkpoint: str, topic: str = ALERT_TOPIC
) -> DataStreamWriter:
    """Stream writer for alerts to a topic. Needs Spark's Kafka connector."""
    return (
        alert_messages(alerts)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )

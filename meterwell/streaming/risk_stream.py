"""Churn-risk alerts as a Structured Streaming job.

The job is the batch operator under a watermark: events in, alert files out.
A window closes when the watermark passes its end, and rows later than that are
dropped and counted by Spark (`numRowsDroppedByWatermark`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterwell.operators.events import corrupt_events, good_events
from meterwell.operators.risk import risk_alerts, window_stats
from meterwell.schemas import RISK_ALERT
from meterwell.settings import DEFAULTS, Settings


def watermarked(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return events.withWatermark("event_time", f"{settings.lateness_seconds} seconds")


def alert_stream(
    decoded: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """Streaming alerts from decoded events; undecodable lines are left out."""
    return risk_alerts(watermarked(good_events(decoded), settings), settings, window_seconds)


def stats_stream(
    decoded: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """Streaming window statistics from decoded events."""
    return window_stats(watermarked(good_events(decoded), settings), settings, window_seconds)


def start_json_sink(
    stream: DataFrame, out_dir: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append finished rows as JSON lines, exactly once per checkpoint.

    `available_now` works through everything that is there and stops; otherwise
    the query keeps running.
    """
    writer = (
        stream.writeStream.format("json")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_corrupt_sink(
    decoded: DataFrame, out_dir: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep the text of lines that could not be decoded."""
    return start_json_sink(corrupt_events(decoded), out_dir, checkpoint, available_now)


def read_alerts(spark: SparkSession, out_dir: str) -> DataFrame:
    """Alerts written so far, with the declared schema."""
    return spark.read.schema(RISK_ALERT).json(out_dir)


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped so far, from the query's kept progress.

    Spark counts rows after its per-task pre-aggregation, so several late events
    of one window and region may count once.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def heartbeat(
    events: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """One event just far enough past the newest one to close every open window.

    For bounded replays. It holds a time and nothing else, so it is counted nowhere and
    its own window never appears.
    """
    ahead = (window_seconds or settings.window_seconds) + settings.lateness_seconds + 1
    latest = events.agg(F.max("event_time").alias("latest")).filter(F.col("latest").isNotNull())
    stamp = F.col("latest") + F.make_interval(secs=F.lit(ahead))
    return latest.select(
        *(
            stamp.alias("event_time")
            if f.name == "event_time"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in events.schema.fields
        )
    )

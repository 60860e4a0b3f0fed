"""The streaming job against the batch operator over the same events."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterwell.operators.risk import risk_alerts, window_stats
from meterwell.sources.messages import append_event_files, stream_event_files
from meterwell.sources.scratch import scratch_dir
from meterwell.streaming.risk_stream import (
    alert_stream,
    heartbeat,
    late_rows,
    read_alerts,
    start_corrupt_sink,
    start_json_sink,
    stats_stream,
)

from helpers import same

HOUR = 3600


def days(usage):
    """The events day by day, as they would arrive."""
    day = F.to_date("event_time")
    dates = [r[0] for r in usage.select(day.alias("d")).distinct().orderBy("d").collect()]
    return [usage.filter(day == d) for d in dates]


def run(spark, source, out, state, build=alert_stream, files=None):
    stream = build(
        stream_event_files(spark, source, max_files_per_batch=files), window_seconds=HOUR
    )
    query = start_json_sink(stream, out, state, available_now=True)
    query.awaitTermination()
    return query


def test_stream_in_several_runs_equals_batch_and_drops_late_rows(spark, usage):
    source, out, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    parts = days(usage)
    third = len(parts) // 3
    for chunk in (parts[:third], parts[third : 2 * third], parts[2 * third :]):
        together = chunk[0]
        for part in chunk[1:]:
            together = together.unionByName(part)
        append_event_files(together.coalesce(1), source)
        run(spark, source, out, state)

    expected = risk_alerts(usage, window_seconds=HOUR)
    append_event_files(heartbeat(usage, window_seconds=HOUR), source)
    run(spark, source, out, state)
    same(read_alerts(spark, out), expected)

    append_event_files(parts[0], source)
    query = run(spark, source, out, state)
    assert late_rows(query) > 0
    same(read_alerts(spark, out), expected)


def test_stats_stream_equals_batch(spark, usage):
    source, out, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    append_event_files(usage.coalesce(1), source)
    run(spark, source, out, state, stats_stream)
    expected = window_stats(usage, window_seconds=HOUR)
    written = spark.read.schema(expected.schema).json(out)
    assert written.count() < expected.count()  # the newest window is still open

    append_event_files(heartbeat(usage, window_seconds=HOUR), source)
    run(spark, source, out, state, stats_stream)
    same(spark.read.schema(expected.schema).json(out), expected)


def test_corrupt_lines_are_kept_aside(spark, usage):
    source, out, state = (scratch_dir(spark, n) for n in ("in", "bad", "state"))
    append_event_files(usage, source)
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(source)
    decoded = stream_event_files(spark, source)
    start_corrupt_sink(decoded, out, state, available_now=True).awaitTermination()
    (line,) = spark.read.text(out).collect()
    assert "{broken" in line.value


def test_heartbeat_raises_no_alert_when_events_follow(spark, usage):
    """The heartbeat's own window closes later and must not appear."""
    source, out, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    append_event_files(usage, source)
    append_event_files(heartbeat(usage, window_seconds=HOUR), source)
    run(spark, source, out, state)
    later = usage.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 60 DAYS"))
    append_event_files(later, source)
    run(spark, source, out, state)
    append_event_files(heartbeat(later, window_seconds=HOUR), source)
    run(spark, source, out, state)
    same(read_alerts(spark, out), risk_alerts(usage.unionByName(later), window_seconds=HOUR))


def test_heartbeat_of_no_events_is_empty(usage):
    assert heartbeat(usage.filter("false")).count() == 0

"""The one-query alert job: replays, late rows, idle end."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterwell.jobs import main
from meterwell.operators.risk import (
    arpu_decline_records,
    risk_alerts,
    risk_records,
    window_arpu_decline,
    window_risk,
    window_stats,
)
from meterwell.sources.messages import append_event_files, stream_event_files
from meterwell.sources.scratch import scratch_dir
from meterwell.sources.tables import folder_names
from meterwell.streaming.one_pass import (
    OnePass,
    corrupt_lines,
    current_alerts,
    current_stats,
    current_windows,
    run_totals,
    run_until_idle,
    start_one_pass,
)

from helpers import same

HOUR = 3600


def folders(spark, *names):
    return [scratch_dir(spark, n) for n in names]


def new_sink(spark, kind=OnePass, seconds=HOUR):
    return kind(*folders(spark, "tables", "alerts", "stats", "corrupt"), window_seconds=seconds)


def run(spark, source, sink, state, files=None):
    decoded = stream_event_files(spark, source, max_files_per_batch=files)
    start_one_pass(decoded, sink, state, available_now=True).awaitTermination()
    return decoded


def check(spark, sink, usage, seconds=HOUR):
    same(current_alerts(spark, sink.alerts, sink.stats), risk_alerts(usage, window_seconds=seconds))
    same(current_stats(spark, sink.stats), window_stats(usage, window_seconds=seconds))
    windows = current_windows(spark, sink.state)
    same(risk_records(windows), window_risk(usage, window_seconds=seconds))
    same(arpu_decline_records(windows), window_arpu_decline(usage, window_seconds=seconds))


def by_time(usage, parts):
    """The events in order of time, in about equal parts."""
    cuts = [usage.selectExpr(f"percentile_approx(event_time, {i / parts})").first()[0] for i in range(1, parts)]
    at = F.col("event_time")
    bounds = [None, *cuts, None]
    return [
        usage.filter((F.lit(True) if a is None else at >= a) & (F.lit(True) if b is None else at < b))
        for a, b in zip(bounds, bounds[1:])
    ]


def test_batches_in_order_write_each_window_once(spark, usage):
    source, state = folders(spark, "in", "state")
    sink = new_sink(spark)
    for part in by_time(usage, 3):
        append_event_files(part.coalesce(1), source)
        decoded = run(spark, source, sink, state)
    open_yet = window_stats(usage, window_seconds=HOUR).count() - current_stats(spark, sink.stats).count()
    assert open_yet >= 1
    sink.close(spark, decoded.schema)
    check(spark, sink, usage)
    sink.close(spark, decoded.schema)  # nothing more to close
    written = spark.read.json(sink.stats)
    assert written.count() == written.select("window").distinct().count()


class Failing(OnePass):
    """Fails once, after all results of the second batch are written."""

    failed = False

    def _finish(self, spark, step, progress):
        if step == 2 and not Failing.failed:
            Failing.failed = True
            raise RuntimeError("lost")
        super()._finish(spark, step, progress)


def test_a_replayed_batch_writes_nothing_twice(spark, usage):
    source, state = folders(spark, "in", "state")
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(source)
    sink = new_sink(spark, Failing)
    first, second, third = by_time(usage, 3)
    append_event_files(first.coalesce(1), source)
    run(spark, source, sink, state)
    append_event_files(second.coalesce(1), source)
    spark.createDataFrame([("{also broken",)], "value string").write.mode("append").text(source)
    with pytest.raises(Exception, match="lost"):
        run(spark, source, sink, state)
    append_event_files(third.coalesce(1), source)
    decoded = run(spark, source, sink, state)
    sink.close(spark, decoded.schema)
    check(spark, sink, usage)
    written = spark.read.json(sink.stats)
    assert written.count() == written.select("window").distinct().count()
    assert spark.read.parquet(sink.received).count() == usage.count() + 2
    assert sorted(r.line for r in corrupt_lines(spark, sink.corrupt).collect()) == ["{also broken", "{broken"]
    totals = run_totals(spark, sink.state).first()
    assert (totals.events, totals.corrupt_lines, totals.late_events) == (usage.count(), 2, 0)


def test_late_rows_are_kept_and_their_windows_repaired(spark, usage):
    source, state = folders(spark, "in", "state")
    sink = new_sink(spark)
    late = F.xxhash64("mobile_number", "event_time") % 50 == 0
    append_event_files(usage.filter(~late), source)
    decoded = run(spark, source, sink, state)
    sink.close(spark, decoded.schema)
    check(spark, sink, usage.filter(~late))
    before = spark.read.json(sink.stats).count()
    append_event_files(usage.filter(late), source)
    run(spark, source, sink, state)
    sink.close(spark, decoded.schema)
    check(spark, sink, usage)
    touched = usage.filter(late).select(F.window("event_time", "1 hour")).distinct().count()
    assert spark.read.json(sink.stats).count() == before + touched
    kept = spark.read.parquet(sink.received).filter("is_late")
    assert kept.count() == usage.filter(late).count() == run_totals(spark, sink.state).first().late_events


def events(spark, rows):
    df = spark.createDataFrame(rows, "circle_id string, at string, calls double")
    return df.selectExpr(
        "1L AS mobile_number", "circle_id", "'2024-01' AS report_month", "calls AS total_calls",
        "calls AS total_data_mb", "1D AS arpu", "1D AS total_rech_amt",
        "timestamp('2024-01-' || at) AS event_time",
    )


def test_a_repaired_window_may_lose_its_alert(spark):
    """Windows longer than a day, so that late rows reach over folders of several days."""
    source, state = folders(spark, "in", "state")
    week = 7 * 86_400
    sink = new_sink(spark, seconds=week)
    early = events(spark, [("a", "05 10:00:00", 0.0), ("b", "06 10:00:00", 0.0), ("a", "20 10:00:00", 1.0)])
    late = events(spark, [("a", f"0{4 + i % 5} 11:00:00", 1.0) for i in range(30)])
    append_event_files(early, source)
    decoded = run(spark, source, sink, state)
    assert {r.circle_id for r in current_alerts(spark, sink.alerts, sink.stats).collect()} == {"a", "b"}
    append_event_files(late, source)
    run(spark, source, sink, state)
    sink.close(spark, decoded.schema)
    check(spark, sink, early.unionByName(late), week)
    assert {r.circle_id for r in current_alerts(spark, sink.alerts, sink.stats).collect()} == {"b"}


def test_ends_after_idling(spark, usage):
    source, state = folders(spark, "in", "state")
    append_event_files(usage, source)
    sink = new_sink(spark)
    run_until_idle(stream_event_files(spark.newSession(), source), sink, state, 1)
    check(spark, sink, usage)
    later = usage.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 60 DAYS"))
    append_event_files(later, source)
    run_until_idle(stream_event_files(spark.newSession(), source), sink, state, 1)
    check(spark, sink, usage.unionByName(later))


def test_job_ends_after_idling(spark, usage):
    source, alerts, stats, corrupt, state = folders(spark, "in", "alerts", "stats", "bad", "state")
    append_event_files(usage, source)
    main(["stream", "--events", source, "--alerts", alerts, "--stats", stats, "--corrupt", corrupt,
          "--checkpoint", state, "--window-size", str(HOUR), "--max-idle", "1"])
    same(current_alerts(spark, alerts, stats), risk_alerts(usage, window_seconds=HOUR))


def test_a_failed_query_closes_nothing(spark, usage):
    source, state = folders(spark, "in", "state")
    append_event_files(usage, source)

    class Broken(OnePass):
        def _compute(self, *args):
            raise RuntimeError("lost")

    sink = new_sink(spark, Broken)
    with pytest.raises(Exception, match="lost"):
        run_until_idle(stream_event_files(spark.newSession(), source), sink, state, 5)
    fine = OnePass(sink.state, sink.alerts, sink.stats, sink.corrupt, window_seconds=HOUR)
    run_until_idle(stream_event_files(spark.newSession(), source), fine, state, 1)
    check(spark, fine, usage)


def test_no_lines(spark, usage):
    source, state = folders(spark, "in", "state")
    usage.filter("false").select(F.lit("x").alias("value")).write.text(source)
    sink = new_sink(spark)
    decoded = run(spark, source, sink, state)
    sink.close(spark, decoded.schema)
    assert not folder_names(spark, sink.stats)

from __future__ import annotations

from meterwell.jobs import main
from meterwell.operators.risk import risk_alerts, window_stats
from meterwell.plans.pipeline import layer_counts
from meterwell.sources.messages import append_event_files, read_event_files
from meterwell.sources.scratch import scratch_dir
from meterwell.sources.wide_csv import write_wide_csv
from meterwell.streaming.one_pass import corrupt_lines, current_alerts, current_stats
from meterwell.streaming.risk_stream import heartbeat

from helpers import ALERT_ROWS, SILENT_ROWS, same


def test_batch_and_events_from_csv(spark, stored_wide):
    csv, out, events = (scratch_dir(spark, n) for n in ("csv", "out", "events"))
    write_wide_csv(stored_wide, csv)
    main(["batch", "--input", csv, "--output", out])
    counts = {r.layer: r.rows for r in layer_counts(spark, out).collect()}
    assert counts["ads_alerts"] == ALERT_ROWS and counts["ads_silent"] == SILENT_ROWS
    main(["events", "--input", csv, "--output", events, "--months", "7,8"])
    months = {r[0] for r in read_event_files(spark, events).select("report_month").collect()}
    assert months == {"2014-07", "2014-08"}


def test_stream_job(spark, usage):
    names = ("in", "alerts", "state", "stats", "corrupt")
    source, alerts, state, stats, corrupt = (scratch_dir(spark, n) for n in names)
    append_event_files(usage, source)
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(source)
    append_event_files(heartbeat(usage, window_seconds=86_400), source)
    main(["stream", "--events", source, "--alerts", alerts, "--stats", stats, "--corrupt",
          corrupt, "--checkpoint", state, "--window-size", "86400", "--once"])
    same(current_stats(spark, stats), window_stats(usage, window_seconds=86_400))
    (line,) = corrupt_lines(spark, corrupt).collect()
    assert "{broken" in line.line
    same(current_alerts(spark, alerts, stats), risk_alerts(usage, window_seconds=86_400))

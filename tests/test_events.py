from __future__ import annotations

import json

from pyspark.sql import functions as F

from meterwell.operators.events import (
    corrupt_events,
    decode_events,
    event_messages,
    good_events,
    narrow_events,
    rich_usage_events,
    usage_events,
)
from meterwell.schemas import RICH_EVENT, STREAM_ROW, USAGE_EVENT
from meterwell.settings import DEFAULTS
from meterwell.sources.messages import alert_messages, read_event_files, write_event_files
from meterwell.sources.scratch import scratch_dir

from helpers import operators, wide_frame


def stamp():
    return F.lit("2014-06-30 10:20:30.123456").cast("timestamp")



def test_month_choice():
    assert DEFAULTS.labels_for("7, 8") == ("2014-07", "2014-08")
    assert DEFAULTS.labels_for(["_9"]) == ("2014-09",)
    assert len(DEFAULTS.labels_for(None)) == 4


def test_missing_nan_and_absent_become_zero(spark):
    wide = wide_frame(
        spark,
        [{"mobile_number": 1, "total_og_mou_6": float("nan"), "total_ic_mou_6": 2.345}],
    ).drop("vol_3g_mb_6")
    (event,) = usage_events(wide, months=["2014-06"], event_time=stamp()).collect()
    assert event.total_calls == 2.35 and event.total_data_mb == 0.0 and event.arpu == 0.0
    assert event._anomaly is False and event.circle_id is None
    rich = rich_usage_events(wide, months=["2014-06"], event_time=stamp()).first()
    assert rich.fb_user == 0 and rich.total_og_mou == 0.0


def test_shapes(spark, stored_wide):
    assert usage_events(stored_wide).columns == USAGE_EVENT.names
    rich = rich_usage_events(stored_wide)
    assert rich.columns == RICH_EVENT.names and len(rich.columns) == 22
    assert len(STREAM_ROW) == 16
    assert operators(usage_events(stored_wide, event_time=stamp()), "Exchange") == 0


def test_month_filter_equals_filter_after(stored_wide):
    months = DEFAULTS.labels_for("7,8")
    few = usage_events(stored_wide, months=months, event_time=stamp())
    every = usage_events(stored_wide, event_time=stamp())
    assert few.count() == every.filter(F.col("report_month").isin(*months)).count()


def test_messages_carry_key_and_micros(spark):
    wide = wide_frame(spark, [{"mobile_number": 12, "circle_id": "北", "arpu_6": 1.5}])
    (message,) = event_messages(usage_events(wide, months=["2014-06"], event_time=stamp())).collect()
    assert message.key == "12_2014-06"
    body = json.loads(message.value)
    assert body["event_time"] == "2014-06-30T10:20:30.123456" and body["circle_id"] == "北"
    assert "北" in message.value and body["arpu"] == 1.5


def test_rich_messages_decode_to_the_same_events(spark, stored_wide):
    rich = rich_usage_events(stored_wide, event_time=stamp())
    decoded = good_events(decode_events(event_messages(rich), RICH_EVENT))
    assert decoded.exceptAll(rich.select(*decoded.columns)).count() == 0
    assert decoded.count() == rich.count()
    assert narrow_events(decoded).columns[3] == "total_calls"


def test_bad_lines_go_to_the_side(spark):
    lines = [
        '{"mobile_number": 1, "circle_id": "a", "event_time": "2024-01-01T00:00:00", "arpu": 1.0}',
        '{"mobile_number": 2, "circle_id": "a", "event_time": "2024-01-01T00:00:00.5"}',
        '{"mobile_number": 3, "event_time": "not a time"}',
        '{"mobile_number": 4',
        '{"mobile_number": "x", "event_time": "2024-01-01T00:00:00"}',
        "",
    ]
    decoded = decode_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r.mobile_number for r in good_events(decoded).collect()] == [1, 2]
    assert {r[0] for r in corrupt_events(decoded).collect()} == set(lines[2:])


def test_event_files_replace_the_folder(spark, usage):
    path = scratch_dir(spark, "events")
    write_event_files(usage, path)
    write_event_files(usage.limit(3), path)
    assert read_event_files(spark, path).count() == 3


def test_alert_messages_are_keyed_by_region(spark):
    alerts = spark.createDataFrame([("r1", "CRITICAL")], "circle_id string, alert_level string")
    (row,) = alert_messages(alerts).collect()
    assert row.key == "r1" and json.loads(row.value)["alert_level"] == "CRITICAL"

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterwell.functions.values import percent_text
from meterwell.operators.risk import (
    alert_summary,
    risk_alerts,
    top_window_alerts,
    window_arpu_decline,
    window_risk,
    window_stats,
)

from helpers import operators, plan


def events(spark, groups: dict[str, list[tuple[float, float, float, int]]]):
    """Events per region from (calls, data, arpu, how many) parts, all in one window."""
    rows = [
        (region, *(None if v is None else float(v) for v in (calls, data, arpu)), 1.0)
        for region, parts in groups.items()
        for calls, data, arpu, n in parts
        for _ in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "circle_id string, total_calls double, total_data_mb double, arpu double, "
        "total_rech_amt double",
    ).withColumn("event_time", F.lit("2024-01-01 00:01:00").cast("timestamp"))


ACTIVE, SILENT, NO_CALLS, NO_DATA = (1, 1, 1), (0, 0, 1), (0, 1, 1), (1, 0, 1)
RICH, RICH_SILENT = (1, 1, 500), (0, 0, 500)

CASES = {
    "silent 30%": ([(*SILENT, 30), (*ACTIVE, 70)], "WARNING", "沉默率偏高: 30.0% | 零通话率: 30.0%"),
    "silent 31%": (
        [(*SILENT, 31), (*ACTIVE, 69)],
        "CRITICAL",
        "高沉默率: 31.0% | 零通话率: 31.0% | 零数据率: 31.0%",
    ),
    "silent 15%": ([(*SILENT, 15), (*ACTIVE, 85)], "INFO", "Normal"),
    "silent 16%": ([(*SILENT, 16), (*ACTIVE, 84)], "WARNING", "沉默率偏高: 16.0%"),
    "no calls 20%": ([(*NO_CALLS, 20), (*ACTIVE, 80)], "INFO", "Normal"),
    "no calls 21%": ([(*NO_CALLS, 21), (*ACTIVE, 79)], "WARNING", "零通话率: 21.0%"),
    "no data 30%": ([(*NO_DATA, 30), (*ACTIVE, 70)], "INFO", "Normal"),
    "no data 31%": ([(*NO_DATA, 31), (*ACTIVE, 69)], "WARNING", "零数据率: 31.0%"),
    "valued 1 of 5": ([(*RICH_SILENT, 1), (*RICH, 4), (*ACTIVE, 95)], "INFO", "Normal"),
    "valued 1 of 6": (
        [(*RICH_SILENT, 1), (*RICH, 5), (*ACTIVE, 94)],
        "CRITICAL",
        "高价值客户沉默: 1/6",
    ),
    "valued 1 of 10": ([(*RICH_SILENT, 1), (*RICH, 9), (*ACTIVE, 90)], "INFO", "Normal"),
    "not quite valued": ([(0, 0, 499.99, 1), (1, 1, 499.99, 9), (*ACTIVE, 90)], "INFO", "Normal"),
}


def test_levels_and_reasons_at_the_thresholds(spark):
    graded = window_risk(events(spark, {name: parts for name, (parts, _, _) in CASES.items()}))
    got = {r.circle_id: (r.alert_level, r.alert_reason) for r in graded.collect()}
    assert got == {name: (level, reason) for name, (_, level, reason) in CASES.items()}


def test_bounds_and_means(spark):
    row = window_risk(events(spark, {"a": [(1, 2, 3, 2), (2, 2, 3, 1)]})).first()
    assert (row.window_start, row.window_end) == ("2024-01-01T00:00:00", "2024-01-01T00:05:00")
    assert (row.customer_count, row.avg_calls, row.avg_data_mb) == (3, 1.33, 2.0)
    assert (row.avg_arpu, row.total_recharge) == (3.0, 3.0)
    hour = window_risk(events(spark, {"a": [(1, 1, 1, 1)]}), window_seconds=3600).first()
    assert hour.window_end == "2024-01-01T01:00:00"


def test_nan_and_null_count_as_zero(spark):
    row = window_risk(events(spark, {"a": [(float("nan"), None, float("nan"), 1)]})).first()
    assert row.silent_count == 1 and row.avg_arpu == 0.0 and row.alert_level == "CRITICAL"


@pytest.mark.parametrize("n", [3, 7, 16, 300])
def test_percent_text_is_half_up(spark, n):
    rows = spark.range(n + 1).select(percent_text("id", F.lit(n)).alias("p"), "id").collect()
    for r in rows:
        tenths = (2000 * r.id + n) // (2 * n)
        assert r.p == f"{tenths // 10}.{tenths % 10}%"


def test_stats_add_up(usage):
    graded = window_risk(usage)
    stats = window_stats(usage)
    total = alert_summary(stats).first()
    assert total.total_events == usage.count()
    assert total.windows == graded.select("window_start").distinct().count()
    assert total.total_alerts == risk_alerts(usage).count() == total.n_critical + total.n_warning
    assert total.total_alerts + total.n_info == graded.count()


def test_aggregates_before_the_shuffle_without_python(usage):
    text = plan(window_risk(usage))
    assert "partial_count" in text and "Python" not in text and "Pandas" not in text
    assert operators(window_risk(usage), "Exchange") == 1


def test_top_alerts_per_window(spark):
    rows = [("w", c, level, s) for c, level, s in (
        ("a", "WARNING", 0.9), ("b", "CRITICAL", 0.2), ("c", "CRITICAL", 0.4), ("d", "WARNING", 0.9),
    )]
    alerts = spark.createDataFrame(
        rows, "window_start string, circle_id string, alert_level string, silent_rate double"
    ).selectExpr("*", "1 customer_count", "0D zero_call_rate", "'' alert_reason")
    got = top_window_alerts(alerts, 3).orderBy("position").collect()
    assert [r.circle_id for r in got] == ["c", "b", "a"]


def test_arpu_decline_against_the_window_before(spark):
    rows = [("a", 100.0, "00:01"), ("a", 50.0, "00:06"), ("a", 20.0, "00:11"), ("b", 9.0, "00:11")]
    df = spark.createDataFrame(rows, "circle_id string, arpu double, at string").selectExpr(
        "circle_id", "arpu", "1D total_calls", "1D total_data_mb", "1D total_rech_amt",
        "timestamp('2024-01-01 ' || at || ':00') AS event_time",
    )
    got = window_arpu_decline(df).orderBy("circle_id", "window_start").collect()
    assert [(r.arpu_decline_pct, r.alert_level) for r in got] == [
        (0.0, "INFO"), (0.5, "INFO"), (0.6, "CRITICAL"), (0.0, "INFO"),
    ]

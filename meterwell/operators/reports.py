"""Saved report queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwell import wording as T
from meterwell.operators.region import region_top


def top_regions(ranking: DataFrame, month: str, n: int = 5) -> DataFrame:
    """Best regions of a month."""
    return region_top(ranking, month, n).select(
        "circle_id", "avg_arpu", "avg_mou_per_user", "active_rate", "composite_score", "rank"
    )


def critical_declines(alerts: DataFrame, month: str, n: int = 20) -> DataFrame:
    """Critical alerts of a month, steepest call decline first."""

    def percent(c: str):
        return F.round(F.col(c) * 100, 1)

    return (
        alerts.filter((F.col("report_month") == month) & (F.col("alert_level") == T.CRITICAL))
        .orderBy(F.desc("calls_decline_pct"), "mobile_number")
        .limit(n)
        .select(
            "mobile_number",
            "circle_id",
            percent("calls_decline_pct").alias("calls_down_pct"),
            percent("data_decline_pct").alias("data_down_pct"),
            "alert_level",
            "alert_reason",
        )
    )


def region_trend(kpi: DataFrame, circle_id: str) -> DataFrame:
    """One region month by month."""
    return (
        kpi.filter(F.col("circle_id") == circle_id)
        .select(
            "report_month",
            "total_customers",
            "active_customers",
            F.round("avg_arpu", 2).alias("avg_arpu"),
            F.round(F.col("active_rate") * 100, 1).alias("active_pct"),
        )
        .orderBy("report_month")
    )


def high_risk_silent(report: DataFrame, month: str, n: int = 50) -> DataFrame:
    """Silent customers of a month who were worth most before."""
    return (
        report.filter((F.col("report_month") == month) & (F.col("risk_level") == T.HIGH))
        .orderBy(F.desc("prev_arpu"), "mobile_number")
        .limit(n)
        .select(
            "mobile_number", "circle_id", "aon", "prev_arpu", "prev_total_calls", "risk_level"
        )
    )

"""Churn-risk windows over usage events. Works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterwell import wording as T
from meterwell.functions.rules import window_rules
from meterwell.functions.values import exact_avg, exact_sum, number
from meterwell.settings import DEFAULTS, Settings

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
_EVENT_KEYS = ("mobile_number", "circle_id", "report_month")


def region_windows(
    events: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """Counters and means per tumbling event-time window and region.

    The event rows are reduced to counters inside each map task, and a stream
    keeps those counters as its only state. `customer_count` counts events. A row that
    carries nothing but a time is no event: it moves a stream's watermark, adds to no
    counter, and a window of such rows only does not appear.
    """
    size = f"{window_seconds or settings.window_seconds} seconds"
    measures = ("total_calls", "total_data_mb", "arpu", "total_rech_amt")
    carried = [c for c in (*_EVENT_KEYS, *measures) if c in events.columns]
    is_event = F.coalesce(*(F.col(c).cast("string") for c in carried)).isNotNull()
    clean = events.withColumn("_is_event", is_event).withColumns(
        {m: F.when(F.col("_is_event"), number(m)) for m in measures}
    )
    silent = "total_calls = 0 AND total_data_mb = 0"
    high_value = f"arpu >= {settings.arpu_high}D"
    counters = {
        "silent_count": silent,
        "zero_call_count": "total_calls = 0",
        "zero_data_count": "total_data_mb = 0",
        "high_value_count": high_value,
        "high_value_silent_count": f"{high_value} AND {silent}",
    }
    return clean.groupBy(F.window("event_time", size).alias("window"), "circle_id").agg(
        F.count_if("_is_event").alias("customer_count"),
        F.round(exact_avg("total_calls"), 2).alias("avg_calls"),
        F.round(exact_avg("total_data_mb"), 2).alias("avg_data_mb"),
        exact_avg("arpu").alias("mean_arpu"),
        F.round(exact_sum("total_rech_amt"), 2).alias("total_recharge"),
        *(F.expr(f"count_if({condition}) AS {name}") for name, condition in counters.items()),
    ).filter("customer_count > 0")


def graded_windows(
    events: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """The region windows with level and reason, from which all reports are made."""
    level, reason = window_rules(settings)
    return region_windows(events, settings, window_seconds).withColumns(
        {"alert_level": level, "alert_reason": reason}
    )


def _bounds() -> list[Column]:
    return [
        F.date_format(f"window.{edge}", ISO_SECONDS).alias(f"window_{edge}")
        for edge in ("start", "end")
    ]


def window_risk(
    events: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """One graded record per window and region, INFO included."""
    return risk_records(graded_windows(events, settings, window_seconds))


def risk_records(graded: DataFrame) -> DataFrame:
    """Graded windows as the records that are given out."""
    n = F.col("customer_count")
    return graded.select(
        "circle_id",
        *_bounds(),
        "customer_count",
        "avg_calls",
        "avg_data_mb",
        F.round("mean_arpu", 2).alias("avg_arpu"),
        "total_recharge",
        "silent_count",
        F.round(F.col("silent_count") / n, 3).alias("silent_rate"),
        F.round(F.col("zero_call_count") / n, 3).alias("zero_call_rate"),
        F.round(F.col("zero_data_count") / n, 3).alias("zero_data_rate"),
        "alert_level",
        "alert_reason",
    )


def risk_alerts(
    events: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """The records that call for action: every level but INFO."""
    return alert_records(graded_windows(events, settings, window_seconds))


def alert_records(graded: DataFrame) -> DataFrame:
    return risk_records(graded).filter(F.col("alert_level") != T.INFO)


def window_stats(
    events: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """Events, regions and alerts per window; INFO counts the regions without one.

    A second aggregate over the region windows. On a stream both run in append
    mode under the same watermark.
    """
    return stats_records(graded_windows(events, settings, window_seconds))


def stats_records(graded: DataFrame) -> DataFrame:
    level = F.col("alert_level")
    return (
        graded.groupBy("window")
        .agg(
            F.sum("customer_count").alias("total_events"),
            F.count("*").alias("circles_analyzed"),
            F.count_if(level != T.INFO).alias("alerts_triggered"),
            *(
                F.count_if(level == name).alias(f"n_{name.lower()}")
                for name in (T.CRITICAL, T.WARNING, T.INFO)
            ),
        )
        .select(
            F.date_format("window.start", ISO_SECONDS).alias("window"),
            "total_events",
            "circles_analyzed",
            "alerts_triggered",
            "n_critical",
            "n_warning",
            "n_info",
        )
    )


def alert_summary(stats: DataFrame) -> DataFrame:
    """One row over all windows: events, windows, alerts and alerts per level."""
    return stats.agg(
        F.sum("total_events").alias("total_events"),
        F.count("*").alias("windows"),
        F.sum("alerts_triggered").alias("total_alerts"),
        *(F.sum(c).alias(c) for c in ("n_critical", "n_warning", "n_info")),
    )


def window_arpu_decline(
    events: DataFrame, settings: Settings = DEFAULTS, window_seconds: int | None = None
) -> DataFrame:
    """Mean revenue of each region window against the region's window before it.

    The window function runs over one row per region window, so its groups grow
    with elapsed time and not with events.
    """
    return arpu_decline_records(region_windows(events, settings, window_seconds), settings)


def arpu_decline_records(windows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The same from region windows that are there already."""
    history = Window.partitionBy("circle_id").orderBy("window.start")
    before, now = F.col("prev_avg_arpu"), F.col("mean_arpu")
    fall = F.when(before > 0, 1 - now / before).otherwise(0.0)
    return (
        windows.withColumn("prev_avg_arpu", F.lag("mean_arpu").over(history))
        .select(
            "circle_id",
            *_bounds(),
            F.round(now, 2).alias("avg_arpu"),
            F.round(before, 2).alias("prev_avg_arpu"),
            F.round(fall, 4).alias("arpu_decline_pct"),
            F.when(fall > settings.window_arpu_drop, T.CRITICAL)
            .otherwise(T.INFO)
            .alias("alert_level"),
        )
    )


def top_window_alerts(alerts: DataFrame, n: int = 3) -> DataFrame:
    """The first `n` alerts of each window, worst first, region id as tie-break."""
    worst_first = Window.partitionBy("window_start").orderBy(
        F.asc("alert_level"), F.desc("silent_rate"), F.asc("circle_id")
    )
    return (
        alerts.withColumn("position", F.row_number().over(worst_first))
        .filter(F.col("position") <= n)
        .select(
            "window_start",
            "position",
            "alert_level",
            "circle_id",
            "customer_count",
            "silent_rate",
            "zero_call_rate",
            "alert_reason",
        )
    )

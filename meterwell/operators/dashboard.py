"""Chart data sets. Sums here let a missing part make the total missing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterwell.functions.values import capped, exact_avg, exact_sum, without_nan, zero
from meterwell.operators.reshape import chosen_months, unpivot
from meterwell.settings import DEFAULTS, Settings

_METRICS = [
    "arpu",
    "total_og_mou",
    "total_ic_mou",
    "total_rech_amt",
    "total_rech_num",
    "vol_2g_mb",
    "vol_3g_mb",
]


def chart_usage(
    wide: DataFrame, settings: Settings = DEFAULTS, months: Iterable[str] | None = None
) -> DataFrame:
    """Seven metrics per customer and month with null-propagating totals."""
    have = wide.columns
    rows = [
        (label, [m + suffix for m in _METRICS])
        for suffix, label in chosen_months(settings, months)
    ]
    absent = [
        m + suffix
        for m in _METRICS
        for suffix, _ in settings.months
        if m + suffix not in have
    ]
    base = wide.withColumns(
        {"circle_id": F.col("circle_id").cast("string"), **{c: F.lit(0.0) for c in absent}}
    )
    usage = without_nan(unpivot(base, ["mobile_number", "circle_id"], _METRICS, rows))
    return usage.withColumns(
        {
            "total_calls": F.col("total_og_mou") + F.col("total_ic_mou"),
            "total_data": F.col("vol_2g_mb") + F.col("vol_3g_mb"),
        }
    )


def _revenue() -> Column:
    return zero(exact_sum("total_rech_amt"))


def dashboard_region_month(usage: DataFrame) -> DataFrame:
    """Mean revenue per user, customers, mean usage and revenue by region and month."""
    return usage.groupBy("circle_id", "report_month").agg(
        exact_avg("arpu").alias("avg_arpu"),
        F.count("mobile_number").alias("total_customers"),
        exact_avg("total_calls").alias("avg_calls"),
        exact_avg("total_data").alias("avg_data"),
        _revenue().alias("total_revenue"),
    )


def dashboard_month_trend(usage: DataFrame) -> DataFrame:
    """Mean revenue per user, revenue, calling users and mean usage by month."""
    return usage.groupBy("report_month").agg(
        exact_avg("arpu").alias("avg_arpu"),
        _revenue().alias("total_revenue"),
        F.count_if(F.col("total_calls") > 0).alias("active_users"),
        exact_avg("total_calls").alias("total_calls_avg"),
        exact_avg("total_data").alias("total_data_avg"),
    )


def latest_month(report: DataFrame) -> DataFrame:
    """Rows of the newest month of a region x month report.

    The maximum is an aggregate of one row, so it can be broadcast whatever the
    report's size. Both uses of the report share its shuffle.
    """
    newest = report.agg(F.max("report_month").alias("_newest"))
    latest = report.join(F.broadcast(newest), F.col("report_month") == F.col("_newest"))
    return latest.drop("_newest")


def dashboard_latest_bubble(region_month: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Newest month by region: revenue against calls, size relative to the largest."""
    largest = F.max("total_customers").over(Window.partitionBy("report_month"))
    return latest_month(region_month).select(
        "circle_id",
        "report_month",
        "avg_arpu",
        "avg_calls",
        "total_customers",
        (F.col("total_customers") / largest * settings.chart_bubble_scale).alias("bubble_size"),
    )


def dashboard_latest_rank(ranking: DataFrame) -> DataFrame:
    """Newest month's scores, lowest first, with the bar label."""
    return ranked_bars(latest_month(ranking))


def ranked_bars(ranking: DataFrame) -> DataFrame:
    """Scores of one month, lowest first, with the bar label."""
    return ranking.select(
        "circle_id",
        "report_month",
        "composite_score",
        F.round("composite_score", 1).alias("score_label"),
    ).orderBy("composite_score", F.desc("circle_id"))


def dashboard_usage_sample(usage: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A fixed-size sample of customer-months for the calls / data scatter.

    Rows are drawn by the order of a seeded digest of their key: the same rows
    on every run and every partitioning, taken as a top-k without a full sort.
    """
    draw = F.md5(
        F.concat_ws("|", "mobile_number", "report_month", F.lit(settings.chart_sample_seed))
    )
    sample = usage.orderBy(draw, "mobile_number", "report_month").limit(
        settings.chart_sample_rows
    )

    def shown(c: str, digits: int) -> Column:
        value = F.round(c, digits)
        text = value.cast("bigint") if digits == 0 else value
        return F.nvl(text.cast("string"), F.lit("nan"))

    # The words of the chart's hover text.
    hover = F.concat(
        F.lit("Circle "), F.nvl("circle_id", F.lit("nan")),
        F.lit("<br>Calls: "), shown("total_calls", 0), F.lit("min"),
        F.lit("<br>Data: "), shown("total_data", 0), F.lit("MB"),
        F.lit("<br>ARPU: "), shown("arpu", 1),
    )
    return sample.select(
        "mobile_number",
        "circle_id",
        "report_month",
        capped("total_calls", settings.chart_max_calls).alias("x_calls"),
        capped("total_data", settings.chart_max_data).alias("y_data"),
        "arpu",
        hover.alias("hover"),
    )

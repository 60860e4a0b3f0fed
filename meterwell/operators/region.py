"""Region-month KPIs and the monthly region ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterwell.functions.rules import calls, min_max_score, roaming
from meterwell.functions.values import exact_avg, exact_sum, ratio
from meterwell.settings import DEFAULTS, Settings

GRAIN = ["circle_id", "report_month"]

KPI_COLUMNS = [
    *GRAIN,
    "total_customers",
    "active_customers",
    "active_rate",
    "avg_tenure_days",
    "total_og_mou",
    "total_ic_mou",
    "avg_mou_per_user",
    "total_recharge_amt",
    "avg_arpu",
    "avg_rech_per_user",
    "total_2g_mb",
    "total_3g_mb",
    "avg_data_mb_per_user",
    "heavy_caller_pct",
    "data_user_pct",
    "high_value_pct",
    "roamer_pct",
    "inactive_customers",
    "inactive_rate",
    "zero_call_customers",
    "zero_data_customers",
]


def _totals() -> dict[str, Column]:
    return {
        "total_customers": F.count("mobile_number"),
        "active_customers": F.sum("is_active"),
        "avg_tenure_days": F.avg("aon"),
        "total_og_mou": exact_sum("nvl(total_og_mou, 0)"),
        "total_ic_mou": exact_sum("nvl(total_ic_mou, 0)"),
        "total_recharge_amt": exact_sum("nvl(total_rech_amt, 0)"),
        "avg_arpu": exact_avg("arpu"),
        "total_2g_mb": exact_sum("nvl(vol_2g_mb, 0)"),
        "total_3g_mb": exact_sum("nvl(vol_3g_mb, 0)"),
    }


def _label_counts(s: Settings) -> dict[str, Column]:
    return {
        "heavy_caller_count": F.count_if(calls() > s.heavy_call_minutes),
        "data_user_count": F.count_if(F.col("total_data_mb") > 0),
        "high_value_count": F.count_if(F.col("arpu") >= s.arpu_high),
        "roamer_count": F.count_if(roaming() > 0),
        "zero_call_customers": F.count_if(F.col("is_active_call") == 0),
        "zero_data_customers": F.count_if(F.col("is_active_data") == 0),
    }


def _with_rates(counted: DataFrame) -> DataFrame:
    per_user = {
        "avg_mou_per_user": F.col("total_og_mou") + F.col("total_ic_mou"),
        "avg_rech_per_user": F.col("total_recharge_amt"),
        "avg_data_mb_per_user": F.col("total_2g_mb") + F.col("total_3g_mb"),
    }
    shares = {
        "active_rate": "active_customers",
        "inactive_rate": "inactive_customers",
        "heavy_caller_pct": "heavy_caller_count",
        "data_user_pct": "data_user_count",
        "high_value_pct": "high_value_count",
        "roamer_pct": "roamer_count",
    }
    return (
        counted.withColumn(
            "inactive_customers", F.col("total_customers") - F.col("active_customers")
        )
        .withColumns({name: ratio(total, "total_customers", 2) for name, total in per_user.items()})
        .withColumns({name: ratio(part, "total_customers", 4) for name, part in shares.items()})
        .select(*KPI_COLUMNS)
    )


def _aggregate(long: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return long.groupBy(*GRAIN).agg(*(c.alias(name) for name, c in columns.items()))


def region_month_kpi(long: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """23-column summary per region and month.

    One aggregate over one scan. Only counters leave a map task, at most one row
    per region and month, so a region that holds most customers costs nothing
    extra.
    """
    return _with_rates(_aggregate(long, {**_totals(), **_label_counts(settings)}))


def region_month_kpi_by_join(long: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The same summary from two aggregates joined on region and month.

    Kept for comparison: it scans twice, and rows of a null region get null
    shares because null keys do not match. Both sides are region x month rows.
    """
    totals = _aggregate(long, _totals())
    counts = _aggregate(long, _label_counts(settings))
    return _with_rates(totals.join(counts, GRAIN, "left"))


def region_scores(kpi: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add the three min-max scores of the month and the weighted score."""
    scored = {
        "arpu_score": ("avg_arpu", settings.weight_arpu),
        "activity_score": ("active_rate", settings.weight_activity),
        "data_score": ("avg_data_mb_per_user", settings.weight_data),
    }
    weighted = [F.col(name) * weight for name, (_, weight) in scored.items()]
    return kpi.withColumns(
        {
            name: min_max_score(source, settings.flat_score)
            for name, (source, _) in scored.items()
        }
    ).withColumn("composite_score", F.round(weighted[0] + weighted[1] + weighted[2], 2))


def region_ranking(
    kpi: DataFrame, settings: Settings = DEFAULTS, ordered: bool = True
) -> DataFrame:
    """Regions ranked within each month, best score first, region id as tie-break.

    The windows see region x month rows only.
    """
    best_first = Window.partitionBy("report_month").orderBy(
        F.desc("composite_score"), F.asc("circle_id")
    )
    ranked = (
        region_scores(kpi, settings)
        .withColumn("rank", F.row_number().over(best_first))
        .select(
            *GRAIN,
            "total_customers",
            "avg_arpu",
            "avg_mou_per_user",
            "avg_data_mb_per_user",
            "active_rate",
            "inactive_rate",
            "arpu_score",
            "activity_score",
            "data_score",
            "composite_score",
            "rank",
        )
    )
    return ranked.orderBy("report_month", "rank") if ordered else ranked


def region_top(ranking: DataFrame, month: str, n: int = 5) -> DataFrame:
    """The first `n` regions of one month."""
    return ranking.filter((F.col("report_month") == month) & (F.col("rank") <= n)).orderBy("rank")

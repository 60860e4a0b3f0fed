"""Customer-month KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwell.functions.rules import calls, roaming
from meterwell.functions.values import flag, zero
from meterwell.settings import DEFAULTS, Settings


def customer_month_kpi(long: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Usage totals and behaviour labels per customer and month.

    Row by row over the long table: no shuffle, one generated stage.
    """
    minutes, data = F.col("total_calls_mou"), F.col("total_data_mb")
    labels = {
        "is_heavy_caller": minutes > settings.heavy_call_minutes,
        "is_heavy_data_user": data > settings.heavy_data_mb,
        "is_high_value": F.col("arpu") >= settings.arpu_high,
        "is_roamer": roaming() > 0,
        "is_data_user": data > 0,
        "is_2g_user": zero("vol_2g_mb") > 0,
        "is_3g_user": zero("vol_3g_mb") > 0,
    }
    per_recharge = F.when(
        zero("total_rech_num") > 0, F.col("total_rech_amt") / F.col("total_rech_num")
    ).otherwise(0.0)
    return long.withColumn("total_calls_mou", calls()).select(
        "mobile_number",
        "circle_id",
        "aon",
        "report_month",
        "total_calls_mou",
        "total_rech_amt",
        "total_data_mb",
        "arpu",
        per_recharge.alias("avg_rech_amt"),
        *(flag(condition).alias(name) for name, condition in labels.items()),
    )

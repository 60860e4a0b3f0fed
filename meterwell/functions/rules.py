"""Business rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterwell import wording as T
from meterwell.functions.values import flag, percent_text, zero
from meterwell.settings import Settings


def calls(prefix: str = "") -> Column:
    """Outgoing plus incoming minutes, missing counted as 0."""
    return zero(f"{prefix}total_og_mou") + zero(f"{prefix}total_ic_mou")


def data_mb() -> Column:
    return zero("vol_2g_mb") + zero("vol_3g_mb")


def roaming() -> Column:
    return zero("roam_og_mou") + zero("roam_ic_mou")


def activity_flags(data: Column) -> dict[str, Column]:
    """The three 0/1 activity columns, given the month's data volume."""
    called = calls() > 0
    used_data = data > 0
    return {
        "is_active_call": flag(called),
        "is_active_data": flag(used_data),
        "is_active": flag(called | used_data),
    }


def min_max_score(name: str, flat: float) -> Column:
    """0-100 position of a value between the month's minimum and maximum."""
    low, high = (f"{f}({name}) OVER (PARTITION BY report_month)" for f in ("min", "max"))
    return F.expr(
        f"CASE WHEN {low} = {high} THEN {flat}D "
        f"ELSE ({name} - {low}) / ({high} - {low}) * 100 END"
    )


def value_band(arpu: str, high, medium, low, s: Settings) -> Column:
    """One of three texts by revenue band; a missing value is in the low band."""
    return (
        F.when(F.col(arpu) >= s.arpu_high, high)
        .when(F.col(arpu) >= s.arpu_medium, medium)
        .otherwise(low)
    )


def decline_level(s: Settings) -> Column:
    return F.when(
        F.greatest("calls_decline_pct", "data_decline_pct") > s.decline_critical, T.CRITICAL
    ).otherwise(T.WARNING)


def decline_reason(s: Settings) -> Column:
    def text(label: str, pct: str) -> Column:
        return F.concat(F.lit(label), F.round(F.col(pct) * 100, 1).cast("string"), F.lit("%"))

    return F.when(
        F.col("calls_decline_pct") > s.decline_alert, text(T.CALL_DROP, "calls_decline_pct")
    ).otherwise(text(T.DATA_DROP, "data_decline_pct"))


def window_rules(s: Settings) -> tuple[Column, Column]:
    """(alert level, reason text) of one region window, from its counters.

    Thresholds test the unrounded ratios. Every count is at least one event, so
    the divisions are safe; the high-value ratio may have no base.
    """
    n = F.col("customer_count")
    silent = F.col("silent_count") / n
    no_calls = F.col("zero_call_count") / n
    no_data = F.col("zero_data_count") / n
    hv_silent = zero(F.try_divide("high_value_silent_count", "high_value_count"))

    very_silent = silent > s.silent_critical
    rather_silent = silent > s.silent_warning
    few_calls = no_calls > s.zero_call_warning
    few_data = no_data > s.zero_data_warning
    lost_value = (hv_silent > s.high_value_silent) & (
        F.col("high_value_count") > s.high_value_min_count
    )

    level = (
        F.when(very_silent | lost_value, T.CRITICAL)
        .when(rather_silent | few_calls | few_data, T.WARNING)
        .otherwise(T.INFO)
    )

    def share(label: str, counter: str) -> Column:
        return F.concat(F.lit(label), percent_text(counter, n))

    reasons = F.concat_ws(
        T.REASON_SEPARATOR,
        F.when(very_silent, share(T.SILENT_VERY_HIGH, "silent_count")).when(
            rather_silent, share(T.SILENT_ELEVATED, "silent_count")
        ),
        F.when(few_calls, share(T.ZERO_CALLS, "zero_call_count")),
        F.when(few_data, share(T.ZERO_DATA, "zero_data_count")),
        F.when(
            lost_value,
            F.concat(
                F.lit(T.HIGH_VALUE_SILENT),
                F.concat_ws("/", F.col("high_value_silent_count"), F.col("high_value_count")),
            ),
        ),
    )
    return level, F.when(reasons == "", F.lit(T.NO_REASON)).otherwise(reasons)

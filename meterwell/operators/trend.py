"""Month-over-month comparison, decline alerts and the silent-customer report."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwell import wording as T
from meterwell.functions.rules import (
    activity_flags,
    calls,
    data_mb,
    decline_level,
    decline_reason,
    value_band,
)
from meterwell.functions.values import decline, without_nan, zero
from meterwell.operators.neighbours import (
    CROWD,
    previous_in_parts,
    spread_copies,
    with_previous_row,
)
from meterwell.operators.reshape import chosen_months, unpivot
from meterwell.settings import DEFAULTS, Settings

_INPUTS = ["arpu", "total_og_mou", "total_ic_mou", "vol_2g_mb", "vol_3g_mb", "total_rech_amt"]

MOVING = ["arpu", "total_og_mou", "total_ic_mou", "total_data_mb", "total_rech_amt"]

PREVIOUS = {
    "arpu": "prev_arpu",
    "total_og_mou": "prev_og_mou",
    "total_ic_mou": "prev_ic_mou",
    "total_data_mb": "prev_data_mb",
    "total_rech_amt": "prev_rech_amt",
}

# First key descending; customer and month make the orders total.
ALERT_ORDER = ["calls_decline_pct", "mobile_number", "report_month"]
SILENT_ORDER = ["prev_arpu", "mobile_number", "report_month"]
FIRST_DESCENDING = [False, True, True]

COMPARED_COLUMNS = [
    "mobile_number",
    "circle_id",
    "aon",
    "report_month",
    *MOVING,
    "is_active_call",
    "is_active_data",
    "prev_month",
    *PREVIOUS.values(),
]


def month_over_month(
    wide: DataFrame, settings: Settings = DEFAULTS, months: Iterable[str] | None = None
) -> DataFrame:
    """Each customer-month beside the same customer's previous month.

    A wide row already holds both months, so this pairs columns instead of
    looking rows up: no shuffle, no sort, no window, and a customer id that
    repeats (or is null) on any number of rows cannot form a hot group. Each
    wide row is compared with itself. `months` trims the scan to those months
    and their predecessors.
    """
    wanted = {label for _, label in chosen_months(settings, months)}
    suffix_of = {label: suffix for suffix, label in settings.months}
    previous = settings.previous()

    def cells(label: str | None) -> list[str | None]:
        return [None if label is None else m + suffix_of[label] for m in _INPUTS]

    rows = [
        (label, [*cells(label), *cells(previous[label])])
        for label in settings.labels
        if label in wanted
    ]
    values = [*_INPUTS, *(f"before_{m}" for m in _INPUTS)]
    pairs = without_nan(unpivot(wide, list(settings.static_columns), values, rows))

    prev_month = F.lit(None).cast("string")
    for label, before in previous.items():
        if before is not None:
            prev_month = F.when(F.col("report_month") == label, before).otherwise(prev_month)

    before_data = zero("before_vol_2g_mb") + zero("before_vol_3g_mb")
    return (
        pairs.withColumns({"total_data_mb": data_mb(), "prev_month": prev_month})
        .withColumns(activity_flags(F.col("total_data_mb")))
        .withColumns(
            {
                "prev_arpu": F.col("before_arpu").cast("double"),
                "prev_og_mou": F.col("before_total_og_mou").cast("double"),
                "prev_ic_mou": F.col("before_total_ic_mou").cast("double"),
                "prev_data_mb": F.when(F.col("prev_month").isNotNull(), before_data),
                "prev_rech_amt": F.col("before_total_rech_amt").cast("double"),
            }
        )
        .select(*COMPARED_COLUMNS)
    )


def month_over_month_long(long: DataFrame, crowd: int = CROWD) -> DataFrame:
    """The same columns from the long table, by looking at each customer's row before.

    For callers that only have the long table. Shuffles and sorts by customer; an
    id on more than `crowd` rows is split over many tasks.
    """
    needed = [c for c in COMPARED_COLUMNS if c in long.columns]
    return _with_previous(
        with_previous_row(
            long.select(*needed), "mobile_number", "report_month", ["report_month", *MOVING], crowd
        )
    )


def month_over_month_bucketed(usual: DataFrame, crowded: DataFrame) -> DataFrame:
    """The same columns from the two parts of a long table in buckets of customers.

    Rows of a usual id lie in one bucket, so they are paired where they are read. What
    shuffles are the rows of crowded ids.
    """
    needed = [c for c in COMPARED_COLUMNS if c in usual.columns]
    return _with_previous(
        previous_in_parts(
            usual.select(*needed), crowded.select(*needed, "_bits"),
            "mobile_number", "report_month", ["report_month", *MOVING],
        )
    )


def _with_previous(paired: DataFrame) -> DataFrame:
    return paired.withColumns(
        {
            "prev_month": F.col("before.report_month"),
            **{prev: F.col(f"before.{now}") for now, prev in PREVIOUS.items()},
        }
    ).select(*COMPARED_COLUMNS)


def usage_decline_alerts(
    compared: DataFrame, settings: Settings = DEFAULTS, ordered: bool = True
) -> DataFrame:
    """Customers whose calls or data fell by more than the alert share.

    Takes the result of either month-over-month operator. A customer without
    outgoing minutes last month raises no alert, whatever the other usage was.
    Customer and month complete the sort key: many alerts share a decline of
    1.0, and without them the range sort would send all of those to one task.
    """
    alerts = (
        compared.filter(F.col("prev_og_mou").isNotNull())
        .withColumns({"curr_calls_mou": calls(), "prev_calls_mou": _previous_calls()})
        .withColumns(
            {
                "calls_decline_pct": decline("curr_calls_mou", "prev_calls_mou"),
                "data_decline_pct": decline("total_data_mb", "prev_data_mb"),
                "recharge_decline_pct": decline("total_rech_amt", "prev_rech_amt"),
            }
        )
        .filter(F.greatest("calls_decline_pct", "data_decline_pct") > settings.decline_alert)
        .select(
            "mobile_number",
            "circle_id",
            "report_month",
            "prev_month",
            "curr_calls_mou",
            F.col("total_data_mb").alias("curr_data_mb"),
            F.col("total_rech_amt").alias("curr_rech_amt"),
            "prev_calls_mou",
            "prev_data_mb",
            "prev_rech_amt",
            "calls_decline_pct",
            "data_decline_pct",
            "recharge_decline_pct",
            decline_level(settings).alias("alert_level"),
            decline_reason(settings).alias("alert_reason"),
        )
    )
    return alerts.orderBy(ALERT_ORDER, ascending=FIRST_DESCENDING) if ordered else alerts


def _previous_calls() -> Column:
    return zero("prev_og_mou") + zero("prev_ic_mou")


def silent_customers(
    compared: DataFrame, settings: Settings = DEFAULTS, ordered: bool = True
) -> DataFrame:
    """Customer-months without any call or data, with last month's value band.

    The silent filter runs on the compared rows, so no join back is needed.
    """
    silent = compared.filter((F.col("is_active_call") == 0) & (F.col("is_active_data") == 0))
    return _silent_report(silent, settings, ordered)


def silent_customers_by_join(
    long: DataFrame, compared: DataFrame, settings: Settings = DEFAULTS, ordered: bool = True
) -> DataFrame:
    """The same report from silent rows joined to their previous-month values.

    Rows meet on all that both sides know of them. Equal rows are counted first and
    the counts are joined, so each row of a repeated or null id meets its own values as
    in the main form, and rows that are alike on any share of the table are one row to
    the shuffle and the join. A row without a partner has no previous values. `compared`
    must be made from `long`: more compared rows than rows of one content are refused.
    """
    shared = ["mobile_number", "report_month", "circle_id", "aon", *MOVING]
    is_silent = (F.col("is_active_call") == 0) & (F.col("is_active_data") == 0)
    previous = list(PREVIOUS.values())
    now = long.filter(is_silent).groupBy(*shared).agg(F.count("*").alias("_now"))
    before = compared.filter(is_silent).groupBy(*shared, *previous).agg(F.count("*").alias("_copies"))
    paired = before.groupBy(*shared).agg(F.sum("_copies").alias("_paired"))

    def met(rows: DataFrame, how: str) -> DataFrame:
        other = rows.select(*(F.col(c).alias(f"_{c}" if c in shared else c) for c in rows.columns))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in shared]
        return now.join(other, reduce(Column.__and__, same), how)

    refused = F.raise_error(F.lit("compared rows that are not rows of the long table"))
    alone = F.col("_now") - F.coalesce("_paired", F.lit(0))
    without = met(paired, "left").select(
        *shared,
        *(F.lit(None).cast("double").alias(c) for c in previous),
        F.when(alone < 0, refused).otherwise(alone).alias("_copies"),
    )
    rows = met(before, "inner").select(*shared, *previous, "_copies")
    rows = rows.unionByName(without.filter("_copies > 0"))
    return _silent_report(spread_copies(rows, "_copies"), settings, ordered)


def _silent_report(silent: DataFrame, s: Settings, ordered: bool) -> DataFrame:
    report = silent.select(
        "mobile_number",
        "circle_id",
        "aon",
        "report_month",
        "prev_arpu",
        _previous_calls().alias("prev_total_calls"),
        F.col("prev_data_mb").alias("prev_data"),
        F.col("prev_rech_amt").alias("prev_rech"),
        value_band("prev_arpu", T.HIGH, T.MEDIUM, T.LOW, s).alias("risk_level"),
        value_band("prev_arpu", T.ADVICE_HIGH, T.ADVICE_MEDIUM, T.ADVICE_LOW, s).alias(
            "recommendation"
        ),
    )
    return report.orderBy(SILENT_ORDER, ascending=FIRST_DESCENDING) if ordered else report


def top_alerts(alerts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The extract of the steepest call declines, a top-k without a full sort."""
    return alerts.orderBy(ALERT_ORDER, ascending=FIRST_DESCENDING).limit(settings.extract_rows)


def top_silent(report: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The extract of the most valuable silent customers."""
    return report.orderBy(SILENT_ORDER, ascending=FIRST_DESCENDING).limit(settings.extract_rows)

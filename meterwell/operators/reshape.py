"""Wide per-month table -> one row per customer and month."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwell.functions.rules import activity_flags, data_mb
from meterwell.functions.values import without_nan
from meterwell.settings import DEFAULTS, Settings


def monthly_metrics(columns: Iterable[str], settings: Settings = DEFAULTS) -> list[str]:
    """Sorted names of the metrics that come as one column per month.

    Reads column names only. The input list may hold any metrics; nothing but
    the month suffix decides.
    """
    suffixes = tuple(suffix for suffix, _ in settings.months)
    found = {
        name[: -len(suffix)] for name in columns for suffix in suffixes if name.endswith(suffix)
    }
    return sorted(found - settings.skipped_metrics)


def chosen_months(
    settings: Settings, months: Iterable[str] | None
) -> list[tuple[str, str]]:
    """(suffix, label) of the wanted months, all by default; unknown labels are refused."""
    wanted = settings.labels if months is None else tuple(months)
    unknown = set(wanted) - set(settings.labels)
    if unknown:
        raise ValueError(f"unknown months: {sorted(unknown)}")
    return [(suffix, label) for suffix, label in settings.months if label in wanted]


def _quoted(names: Iterable[str]) -> str:
    return ", ".join(f"`{name}`" for name in names)


def unpivot(
    wide: DataFrame,
    keys: list[str],
    values: list[str],
    rows: list[tuple[str, list[str | None]]],
    label_column: str = "report_month",
) -> DataFrame:
    """One output row per input row and label, several value columns at once.

    `rows` gives each label its source columns, one per value column; a source
    that is None, or that the input lacks, is null. Spark plans this as a single
    `Expand` above one scan. Unlike an exploded array of structs, `Expand` lets
    column pruning through, so a query that uses five metrics reads only those
    from the files. Nothing is shuffled.
    """
    have = set(wide.columns)
    absent = "_absent"
    branches = ", ".join(
        f"({_quoted(s if s in have else absent for s in sources)}) AS `{label}`"
        for label, sources in rows
    )
    used = dict.fromkeys(s for _, sources in rows for s in sources if s in have)
    return wide.sparkSession.sql(
        f"SELECT * FROM (SELECT {_quoted([*keys, *used])}, NULL AS {absent} FROM {{wide}}) "
        f"UNPIVOT INCLUDE NULLS "
        f"(({_quoted(values)}) FOR `{label_column}` IN ({branches}))",
        wide=wide,
    ).select(*keys, *values, label_column)


def wide_to_long(
    wide: DataFrame,
    settings: Settings = DEFAULTS,
    months: Iterable[str] | None = None,
    extra_static: Iterable[str] = (),
) -> DataFrame:
    """Long detail table: static columns, every metric, month, activity columns.

    `months` limits the output to some month labels, and the scan to their
    columns. A metric that lacks a month's column is null in that month. Rows
    whose metrics are all null are kept.
    """
    metrics = monthly_metrics(wide.columns, settings)
    static = [c for c in (*settings.static_columns, *extra_static) if c in wide.columns]
    rows = [
        (label, [metric + suffix for metric in metrics])
        for suffix, label in chosen_months(settings, months)
    ]
    return with_activity(without_nan(unpivot(wide, static, metrics, rows)))


def wide_to_long_by_union(
    wide: DataFrame, settings: Settings = DEFAULTS, months: Iterable[str] | None = None
) -> DataFrame:
    """The same rows from one select per month.

    Scans the input once per month, but a later filter on `report_month` removes
    whole branches, which suits a view that is always read one month at a time.
    `wide` should be a stored table. Each branch repeats the work that builds `wide`,
    and Spark may run all branches of a shuffled input in one task, which then holds
    the memory of every one of them.
    """
    metrics = monthly_metrics(wide.columns, settings)
    static = [c for c in settings.static_columns if c in wide.columns]
    branches = [
        wide.select(
            *static,
            *(F.col(m + suffix).alias(m) for m in metrics if m + suffix in wide.columns),
            F.lit(label).alias("report_month"),
        )
        for suffix, label in chosen_months(settings, months)
    ]
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return with_activity(without_nan(long.select(*static, *metrics, "report_month")))


def with_activity(long: DataFrame) -> DataFrame:
    """Add data volume and the call / data / any activity flags."""
    return long.withColumns({"total_data_mb": data_mb()}).withColumns(
        activity_flags(F.col("total_data_mb"))
    )

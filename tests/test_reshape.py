from __future__ import annotations

import pytest

from meterwell.operators.reshape import monthly_metrics, wide_to_long, wide_to_long_by_union
from meterwell.plans import catalogue
from meterwell.sources.star import STAR

from conftest import SF_DIR
from helpers import operators, plan, same, wide_frame


def test_metric_names_come_from_suffixes_only():
    columns = ["mobile_number", "arpu_6", "arpu_9", "new_thing_7", "last_date_of_month_6", "x_10"]
    assert monthly_metrics(columns) == ["arpu", "new_thing"]


def test_rows_and_flags(spark):
    wide = wide_frame(
        spark,
        [
            {"mobile_number": 1, "circle_id": "a", "total_og_mou_6": 0, "total_ic_mou_6": 2},
            {"mobile_number": 2, "circle_id": None, "vol_3g_mb_9": 5},
        ],
    )
    rows = {(r.mobile_number, r.report_month): r for r in wide_to_long(wide).collect()}
    assert len(rows) == 8
    called = rows[1, "2014-06"]
    assert (called.is_active_call, called.is_active_data, called.is_active) == (1, 0, 1)
    data = rows[2, "2014-09"]
    assert (data.is_active_call, data.is_active_data, data.is_active) == (0, 1, 1)
    assert data.total_data_mb == 5.0
    empty = rows[2, "2014-06"]
    assert empty.total_data_mb == 0.0 and empty.is_active == 0 and empty.vol_2g_mb is None


def test_union_gives_the_same_rows(stored_wide):
    same(wide_to_long(stored_wide), wide_to_long_by_union(stored_wide))


def test_union_query_builds_the_wide_rows_once(spark):
    """Its branches only scan, so no task holds the aggregations of several months."""
    long = catalogue.wide_to_long_union(spark, SF_DIR)
    assert operators(long, "Scan parquet") == len(STAR.months)
    assert operators(long, "Exchange") == operators(long, "HashAggregate") == 0
    same(long, catalogue.wide_to_long(spark, SF_DIR))


def test_row_count_is_customers_times_months(stored_wide):
    assert wide_to_long(stored_wide).count() == 4 * stored_wide.count()


def test_month_without_a_column_is_null(spark):
    wide = wide_frame(spark, [{"mobile_number": 1, "arpu_6": 7, "arpu_7": 8}]).drop("arpu_7")
    for long in (wide_to_long(wide), wide_to_long_by_union(wide)):
        got = {r.report_month: r.arpu for r in long.collect()}
        assert got == {"2014-06": 7.0, "2014-07": None, "2014-08": None, "2014-09": None}
        assert dict(long.dtypes)["arpu"] == "double"


def test_months_limit_rows_and_reject_unknown(spark, stored_wide):
    long = wide_to_long(stored_wide, months=["2014-08"])
    assert {r.report_month for r in long.select("report_month").distinct().collect()} == {"2014-08"}
    assert "arpu_7" not in plan(long)
    with pytest.raises(ValueError):
        wide_to_long(stored_wide, months=["2015-01"])


def test_one_scan_no_shuffle_and_only_used_columns(stored_wide):
    long = wide_to_long(stored_wide).select("mobile_number", "report_month", "arpu")
    assert operators(long, "Scan parquet") == 1
    assert operators(long, "Exchange") == 0
    text = plan(long)
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "arpu_6" in schema and "og_mou" not in schema and "circle_id" not in schema


def test_unsuffixed_month_columns_are_dropped_unless_asked_for(stored_wide):
    assert "jun_vbc_3g" not in wide_to_long(stored_wide).columns
    assert "jun_vbc_3g" in wide_to_long(stored_wide, extra_static=["jun_vbc_3g"]).columns

from __future__ import annotations

from pyspark.sql import functions as F

import pytest

from meterwell.functions.values import exact_avg, exact_sum
from meterwell.operators.customer import customer_month_kpi
from meterwell.operators.region import (
    region_month_kpi,
    region_month_kpi_by_join,
    region_ranking,
    region_scores,
)
from meterwell.operators.reshape import wide_to_long

from helpers import operators, same, wide_frame


def test_exact_sum_ignores_order_and_missing(spark):
    values = [0.1, 0.2, 0.3, 1e6, -1e6, -0.7, None, 12.345678]
    for data in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in data], "x double")
        got = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
        assert got.s == 12.245678
        assert got.a == 12.245678 / 7


@pytest.mark.parametrize(
    "values",
    [[1e-7] * 1000, [1e19, 3.5], [float("inf"), 1.0], [float("inf"), float("-inf")],
     [float("nan"), 2.0], [1 / 3, 2 / 3, 1e300], [1e10 + 0.25, -3.0]],
)
def test_exact_sum_is_sum_for_every_input(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(
        exact_sum("x").alias("s"), exact_avg("x").alias("a"), F.sum("x").alias("t"), F.avg("x").alias("b")
    ).first()
    assert got.s == pytest.approx(got.t, rel=1e-12, nan_ok=True)
    assert got.a == pytest.approx(got.b, rel=1e-12, nan_ok=True)


def test_exact_sum_of_a_million_tiny_values(spark):
    df = spark.range(1_000_000).selectExpr("1e-7D AS x")
    assert df.agg(exact_sum("x").alias("s")).first().s == pytest.approx(0.1, rel=1e-9)


def test_nan_is_missing_in_every_reader_of_wide_rows(spark):
    nan = float("nan")
    wide = wide_frame(
        spark, [{"mobile_number": 1, "total_og_mou_6": nan, "vol_2g_mb_6": nan, "arpu_6": nan}]
    )
    row = wide_to_long(wide, months=["2014-06"]).first()
    assert (row.total_og_mou, row.arpu, row.is_active, row.total_data_mb) == (None, None, 0, 0.0)
    kpi = region_month_kpi(wide_to_long(wide, months=["2014-06"])).first()
    assert (kpi.active_customers, kpi.total_og_mou, kpi.avg_arpu) == (0, 0.0, None)


def test_exact_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first() == (None, None)


def test_thresholds_of_customer_labels(spark):
    wide = wide_frame(
        spark,
        [
            {"mobile_number": 1, "total_og_mou_6": 500, "vol_2g_mb_6": 1024, "arpu_6": 500},
            {"mobile_number": 2, "total_og_mou_6": 500.01, "vol_3g_mb_6": 1024.01, "arpu_6": 499.99},
            {"mobile_number": 3, "roam_ic_mou_6": 1, "total_rech_num_6": 4, "total_rech_amt_6": 10},
            {"mobile_number": 4, "total_rech_num_6": 0, "total_rech_amt_6": 10},
            {"mobile_number": 5, "total_rech_num_6": 2},
        ],
    )
    kpi = customer_month_kpi(wide_to_long(wide, months=["2014-06"]))
    got = {r.mobile_number: r for r in kpi.collect()}
    assert (got[1].is_heavy_caller, got[1].is_heavy_data_user, got[1].is_high_value) == (0, 0, 1)
    assert (got[2].is_heavy_caller, got[2].is_heavy_data_user, got[2].is_high_value) == (1, 1, 0)
    assert (got[1].is_2g_user, got[1].is_3g_user, got[2].is_2g_user, got[2].is_3g_user) == (1, 0, 0, 1)
    assert got[3].is_roamer == 1 and got[3].avg_rech_amt == 2.5 and got[3].is_high_value == 0
    assert got[4].avg_rech_amt == 0.0
    assert got[5].avg_rech_amt is None
    assert len(kpi.columns) == 16


def test_region_kpi_without_join_equals_join(stored_wide):
    long = wide_to_long(stored_wide)
    same(region_month_kpi(long), region_month_kpi_by_join(long))
    assert operators(region_month_kpi(long), "Join") == 0
    assert operators(region_month_kpi(long), "Scan parquet") == 1
    assert operators(region_month_kpi(long), "Exchange") == 1


def test_null_region_keeps_its_shares(spark):
    wide = wide_frame(spark, [{"mobile_number": 1, "arpu_6": 600, "total_og_mou_6": 600}])
    long = wide_to_long(wide, months=["2014-06"])
    row = region_month_kpi(long).first()
    assert row.circle_id is None and row.high_value_pct == 1.0
    assert region_month_kpi_by_join(long).first().high_value_pct is None


def test_region_of_null_customers_has_no_rates(spark):
    wide = wide_frame(spark, [{"mobile_number": None, "circle_id": "a", "total_og_mou_6": 3}])
    row = region_month_kpi(wide_to_long(wide, months=["2014-06"])).first()
    assert row.total_customers == 0 and row.active_rate is None and row.total_og_mou == 3.0


def test_region_invariants(stored_wide):
    kpi = region_month_kpi(wide_to_long(stored_wide))
    broken = kpi.filter(
        (F.col("active_customers") + F.col("inactive_customers") != F.col("total_customers"))
        | (F.abs(F.col("active_rate") + F.col("inactive_rate") - 1) > 1e-9)
    )
    assert broken.count() == 0 and len(kpi.columns) == 23


def _kpi_rows(spark, rows):
    ddl = (
        "circle_id string, report_month string, total_customers long, avg_arpu double, "
        "avg_mou_per_user double, avg_data_mb_per_user double, active_rate double, "
        "inactive_rate double"
    )
    return spark.createDataFrame(
        [(c, m, 1, arpu, 0.0, data, rate, 1 - rate) for c, m, arpu, rate, data in rows], ddl
    )


def test_scores(spark):
    kpi = _kpi_rows(
        spark,
        [
            ("a", "m1", 100.0, 0.5, 10.0),
            ("b", "m1", 200.0, 0.5, 30.0),
            ("c", "m1", 150.0, 0.5, 20.0),
            ("a", "m2", 7.0, 0.1, 1.0),
        ],
    )
    got = {(r.circle_id, r.report_month): r for r in region_scores(kpi).collect()}
    assert (got["b", "m1"].arpu_score, got["b", "m1"].activity_score) == (100.0, 50.0)
    assert got["b", "m1"].composite_score == 82.5
    assert got["c", "m1"].composite_score == 50.0
    assert got["a", "m1"].composite_score == 17.5
    alone = got["a", "m2"]
    assert (alone.arpu_score, alone.activity_score, alone.data_score) == (50.0, 50.0, 50.0)
    assert alone.composite_score == 50.0


def test_rank_breaks_ties_by_region(spark):
    kpi = _kpi_rows(spark, [(c, "m", 5.0, 0.5, 5.0) for c in ("z", "b", "k")])
    assert [(r.circle_id, r["rank"]) for r in region_ranking(kpi).collect()] == [
        ("b", 1), ("k", 2), ("z", 3),
    ]


def test_ranks_are_dense_and_scores_bounded(stored_wide):
    ranking = region_ranking(region_month_kpi(wide_to_long(stored_wide)))
    per_month = ranking.groupBy("report_month").agg(
        F.count("*").alias("n"),
        F.min("rank").alias("low"),
        F.max("rank").alias("high"),
        F.countDistinct("rank").alias("different"),
    )
    assert all(r.low == 1 and r.n == r.high == r.different for r in per_month.collect())
    for c in ("arpu_score", "activity_score", "data_score", "composite_score"):
        assert ranking.filter(~F.col(c).between(0, 100)).count() == 0

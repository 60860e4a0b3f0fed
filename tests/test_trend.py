from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from meterwell.operators import neighbours
from meterwell.operators.neighbours import spread_copies, with_previous_row
from meterwell.operators.reshape import wide_to_long
from meterwell.operators.trend import (
    month_over_month,
    month_over_month_long,
    silent_customers,
    silent_customers_by_join,
    top_alerts,
    usage_decline_alerts,
)

from helpers import operators, plan, same, wide_frame


def _alerts(spark, **months):
    row = {"mobile_number": 1, "circle_id": "a"}
    for name, values in months.items():
        for suffix, value in zip(("_6", "_7", "_8", "_9"), values):
            row[name + suffix] = value
    return usage_decline_alerts(month_over_month(wide_frame(spark, [row]))).collect()


def test_pairs_equal_lag(stored_wide):
    same(month_over_month(stored_wide), month_over_month_long(wide_to_long(stored_wide)))


def test_pairs_need_no_shuffle(stored_wide):
    compared = month_over_month(stored_wide)
    assert operators(compared, "Exchange") == operators(compared, "Window") == 0
    assert operators(compared, "Scan parquet") == 1


def test_one_month_reads_two_months_of_columns(stored_wide):
    text = plan(month_over_month(stored_wide, months=["2014-09"]))
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "arpu_9" in schema and "arpu_8" in schema and "arpu_7" not in schema


def test_single_first_month_has_typed_nulls(stored_wide):
    compared = month_over_month(stored_wide, months=["2014-06"])
    assert dict(compared.dtypes)["prev_arpu"] == "double"
    assert compared.filter("prev_month is not null or prev_data_mb is not null").count() == 0


def test_decline_needs_more_than_half(spark):
    assert _alerts(spark, total_og_mou=[100, 50, 50, 50]) == []
    (alert,) = _alerts(spark, total_og_mou=[100, 49.9, 49.9, 49.9])
    assert alert.calls_decline_pct == 0.501 and alert.alert_level == "WARNING"
    assert alert.alert_reason == "通话下降50.1%" and alert.prev_month == "2014-06"


def test_critical_needs_more_than_four_fifths(spark):
    (at,) = _alerts(spark, total_og_mou=[100, 20, 20, 20])
    assert at.calls_decline_pct == 0.8 and at.alert_level == "WARNING"
    (over,) = _alerts(spark, total_og_mou=[100, 19.9, 19.9, 19.9])
    assert over.alert_level == "CRITICAL"


def test_data_decline_alone(spark):
    (alert,) = _alerts(spark, total_og_mou=[1, 1, 1, 1], vol_3g_mb=[1000, 100, 100, 100])
    assert alert.alert_reason == "流量下降90.0%" and alert.calls_decline_pct == 0.0


def test_null_outgoing_last_month_raises_no_alert(spark):
    assert _alerts(spark, total_ic_mou=[100, 1, 1, 1]) == []


def test_zero_before_is_no_decline_and_growth_is_negative(spark):
    assert _alerts(spark, total_og_mou=[0, 0, 0, 0], vol_2g_mb=[0, 5, 5, 5]) == []
    rows = _alerts(spark, total_og_mou=[10, 40, 1, 1], total_rech_amt=[5, 10, None, 1])
    (alert,) = rows
    assert alert.report_month == "2014-08" and alert.recharge_decline_pct is None


def test_silent_bands(spark):
    rows = [
        {"mobile_number": i, "total_og_mou_6": 1, "arpu_6": arpu}
        for i, arpu in enumerate([500, 499.99, 200, 199.99, None])
    ]
    report = silent_customers(month_over_month(wide_frame(spark, rows), months=["2014-07"]))
    got = {r.mobile_number: r for r in report.collect()}
    assert [got[i].risk_level for i in range(5)] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert got[0].recommendation == "高价值客户沉默, 建议客服48小时内回访"
    assert got[0].prev_total_calls == 1.0 and got[0].prev_data == 0.0


def test_silent_first_month_is_low(spark):
    wide = wide_frame(spark, [{"mobile_number": 1}])
    row = silent_customers(month_over_month(wide, months=["2014-06"])).first()
    assert (row.risk_level, row.prev_total_calls, row.prev_data) == ("LOW", 0.0, None)


def test_silent_without_join_equals_join(stored_wide):
    compared, long = month_over_month(stored_wide), wide_to_long(stored_wide)
    same(silent_customers(compared), silent_customers_by_join(long, compared))
    assert operators(silent_customers(compared, ordered=False), "Exchange") == 0


def test_join_form_does_not_multiply_repeated_keys(spark):
    wide = wide_frame(spark, [{"mobile_number": 1}] * 20)
    compared, long = month_over_month(wide), wide_to_long(wide)
    assert silent_customers_by_join(long, compared).count() == 80


def test_join_form_counts_equal_rows(spark):
    """A third of the rows alike, a third alike but for last month: no window, no row lost."""
    rows = [{"mobile_number": None}] * 60 + [
        {"mobile_number": None, "total_og_mou_6": float(i % 7), "arpu_6": 300.0} for i in range(60)
    ]
    wide = wide_frame(spark, rows + [{"mobile_number": i, "arpu_6": 600.0} for i in range(60)])
    compared, long = month_over_month(wide), wide_to_long(wide)
    same(silent_customers(compared), silent_customers_by_join(long, compared))
    assert operators(silent_customers_by_join(long, compared), "Window") == 0
    # Rows without a partner have no previous values, and foreign rows are refused.
    only = silent_customers_by_join(long, compared.filter("mobile_number IS NOT NULL"))
    assert only.count() == silent_customers(compared).count()
    assert only.filter("mobile_number IS NULL AND prev_arpu IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="not rows of the long table"):
        silent_customers_by_join(long, compared.unionByName(compared)).collect()


def test_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_COPIES_PER_TASK_ROW", 10)
    rows = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 95)], "k string, n long")
    counts = {r.k: r["count"] for r in spread_copies(rows, "n").groupBy("k").count().collect()}
    assert counts == {"a": 1, "b": 10, "c": 11, "d": 95}


def test_repeated_and_null_ids_keep_every_row(spark):
    """A third of the rows share an id, another third has none; each row is its own pair."""
    rows = [
        {"mobile_number": key, "circle_id": "a", "total_og_mou_6": 100, "total_og_mou_7": i % 3}
        for i, key in enumerate([7] * 40 + [None] * 40 + list(range(100, 140)))
    ]
    wide = wide_frame(spark, rows)
    compared = month_over_month(wide, months=["2014-07"])
    assert compared.count() == 120
    alerts = usage_decline_alerts(compared)
    assert alerts.count() == 120 and alerts.filter("prev_calls_mou <> 100").count() == 0
    assert silent_customers(compared).count() == 40
    long = wide_to_long(wide, months=["2014-06", "2014-07"])
    assert month_over_month_long(long, crowd=20).count() == 240


def test_alerts_are_long_rows_and_silent_are_inactive(stored_wide):
    compared = month_over_month(stored_wide)
    long = wide_to_long(stored_wide)
    grain = ["mobile_number", "report_month"]
    assert usage_decline_alerts(compared).join(long, grain, "left_anti").count() == 0
    active = long.filter("is_active = 1")
    assert silent_customers(compared).join(active, grain, "left_semi").count() == 0


def test_top_k_without_a_full_sort(stored_wide):
    top = top_alerts(usage_decline_alerts(month_over_month(stored_wide), ordered=False))
    assert operators(top, "TakeOrderedAndProject") == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_split_keys_give_the_same_pairs(spark, seed):
    """A crowded id, a null id and many exact copies, split and not split."""
    rng = random.Random(seed)
    rows = []
    for _ in range(1500):
        key = rng.choice([None, 7, 7, 7, rng.randrange(1000, 1400)])
        rows.append((key, f"2014-0{rng.randrange(6, 10)}", float(rng.randrange(40))))
    rows += [(7, "2014-07", 1.0)] * 700 + [(None, "2014-06", 2.0)] * 300
    df = spark.createDataFrame(rows, "k long, m string, v double").repartition(5)

    def pairs(crowd):
        out = with_previous_row(df, "k", "m", ["m", "v"], crowd)
        return out.select("k", "m", "v", F.col("before.m").alias("pm"), F.col("before.v").alias("pv"))

    split, plain = pairs(50), pairs(10**9)
    same(split, plain)
    assert split.count() == len(rows)
    firsts = split.filter("pm is null").count()
    assert firsts == len({k for k, _, _ in rows})


def test_split_pairs_against_brute_force(spark):
    rows = [(1, f"2014-0{m}", float(v)) for m in (6, 7) for v in range(100)]
    df = spark.createDataFrame(rows, "k long, m string, v double")
    tied = df.withColumn("t", F.xxhash64("k", "m", "v")).collect()
    ordered = sorted(((r.m, r.t, r.v) for r in tied))
    expected = {ordered[0][::2]: None}
    expected |= {b[::2]: a[::2] for a, b in zip(ordered, ordered[1:])}
    got = with_previous_row(df, "k", "m", ["m", "v"], crowd=10).collect()
    assert {(r.m, r.v): None if r.before is None else tuple(r.before) for r in got} == expected


def test_lag_reads_its_input_twice_with_a_crowded_key(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 50 END AS k", "concat('m', id % 7) AS m", "id AS v"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    out = with_previous_row(df, "k", "m", ["m", "v"], crowd=100)
    # What is left to run reads the written rows only: two scans went before it.
    assert path not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 3000

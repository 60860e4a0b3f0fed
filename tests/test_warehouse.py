from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from meterwell.operators import dashboard, reports
from meterwell.plans.pipeline import (
    ALERTS,
    LAYERS,
    RANKING,
    SILENT,
    layer_counts,
    run_pipeline,
    written_counts,
)
from meterwell.schemas import DETAIL_TABLE, RAW_TABLE, TABLES, mismatches, wide_schema
from meterwell.sources.extracts import read_extract
from meterwell.sources.scratch import scratch_dir
from meterwell.sources.star import STAR
from meterwell.sources.tables import (
    read_latest_month,
    read_table,
    read_table_if_written,
    register_tables,
    write_table,
)
from meterwell.sources.wide_csv import read_csv_inferred, read_wide_csv, write_wide_csv

from helpers import ALERT_ROWS, SILENT_ROWS, operators, plan, same, wide_frame


@pytest.fixture(scope="module")
def warehouse(spark, stored_wide):
    root = scratch_dir(spark, "warehouse")
    return root, run_pipeline(stored_wide, root)


def test_layers_are_written_to_their_contracts(spark, warehouse, stored_wide):
    root, paths = warehouse
    assert set(LAYERS.values()) < set(paths)
    for name, contract in TABLES.items():
        assert mismatches(read_table(spark, root, name).schema, contract) == []
    counts = {r.layer: r.rows for r in layer_counts(spark, root).collect()}
    n = stored_wide.count()
    assert counts["ods_raw"] == n and counts["dwd_long"] == counts["dws_customer_kpi"] == 4 * n
    assert counts["dws_circle_kpi"] == counts["ads_ranking"] == 100
    assert (counts["ads_alerts"], counts["ads_silent"]) == (ALERT_ROWS, SILENT_ROWS)


def test_month_filter_prunes_partitions(spark, warehouse):
    root, _ = warehouse
    one = read_table(spark, root, ALERTS, months=["2014-09"])
    assert "PartitionFilters: [isnotnull(report_month" in plan(one)
    assert one.inputFiles()


def test_raw_table_keeps_region_as_text(spark, warehouse, stored_wide):
    root, _ = warehouse
    raw = read_table(spark, root, RAW_TABLE)
    assert dict(raw.dtypes)["circle_id"] == "string"
    same(raw, stored_wide)


def test_one_month_run_replaces_only_that_month(spark, stored_wide):
    root = scratch_dir(spark, "warehouse")
    run_pipeline(stored_wide, root)
    before = {n: read_table(spark, root, n).count() for n in (DETAIL_TABLE, ALERTS, SILENT)}
    silent_now = stored_wide.withColumns({"total_og_mou_9": F.lit(0.0), "total_ic_mou_9": F.lit(0.0),
                                          "vol_2g_mb_9": F.lit(0.0), "vol_3g_mb_9": F.lit(0.0)})
    run_pipeline(silent_now, root, months=["2014-09"])
    silent = read_table(spark, root, SILENT)
    assert silent.filter("report_month = '2014-09'").count() == stored_wide.count()
    assert read_table(spark, root, DETAIL_TABLE).count() == before[DETAIL_TABLE]
    assert silent.filter("report_month < '2014-09'").count() > 0
    assert read_table(spark, root, RANKING).count() == 100


def test_extracts(spark, warehouse):
    _, paths = warehouse
    extract = read_extract(spark, paths["circle_ranking"], TABLES[RANKING])
    assert extract.count() == 100
    top = read_extract(spark, paths["decline_alerts"], TABLES[ALERTS])
    assert len(top.inputFiles()) == 1 and top.count() == ALERT_ROWS


def test_contract_violation_is_refused(spark):
    with pytest.raises(ValueError, match="risk_level"):
        write_table(spark.range(1), scratch_dir(spark, "x"), SILENT)


def test_catalog_tables(spark, warehouse):
    root, _ = warehouse
    names = register_tables(spark, root, "usage_marts")
    assert len(names) == 7
    register_tables(spark, root, "usage_marts", [RANKING])
    got = spark.sql(f"SELECT * FROM usage_marts.{RANKING} WHERE report_month = '2014-09'")
    assert got.count() == 25
    spark.sql("DROP DATABASE usage_marts CASCADE")
    assert read_table(spark, root, RANKING).count() == 100


def test_catalog_tables_before_the_first_run(spark, stored_wide):
    root = scratch_dir(spark, "declared")
    register_tables(spark, root, "declared_marts")
    detail = spark.table(f"declared_marts.{DETAIL_TABLE}")
    assert detail.count() == 0 and detail.columns[-1] == "report_month"
    assert len(spark.table(f"declared_marts.{RAW_TABLE}").columns) == 110
    spark.sql("DROP DATABASE declared_marts CASCADE")


def test_table_before_its_first_run(spark, warehouse):
    root, _ = warehouse
    assert read_table_if_written(spark, root, RANKING).count() == 100
    assert read_table_if_written(spark, scratch_dir(spark, "empty"), RANKING) is None


def test_saved_reports(spark, warehouse):
    root, _ = warehouse
    top = reports.top_regions(read_table(spark, root, RANKING), "2014-09").collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    critical = reports.critical_declines(read_table(spark, root, ALERTS), "2014-09")
    assert critical.count() == 20 and operators(critical, "TakeOrderedAndProject") == 1
    high = reports.high_risk_silent(read_table(spark, root, SILENT), "2014-09").collect()
    assert all(r.risk_level == "HIGH" for r in high)


def test_rank_filter_is_limited_early(stored_wide):
    from meterwell.operators.region import region_month_kpi, region_ranking, region_top
    from meterwell.operators.reshape import wide_to_long

    ranking = region_ranking(region_month_kpi(wide_to_long(stored_wide)), ordered=False)
    assert "WindowGroupLimit" in plan(region_top(ranking, "2014-09"))


def test_csv_types_come_from_the_header(spark, stored_wide):
    path = scratch_dir(spark, "csv")
    write_wide_csv(stored_wide, path)
    back = read_wide_csv(spark, path, STAR)
    assert back.dtypes == stored_wide.dtypes
    same(back, stored_wide)
    inferred = dict(read_csv_inferred(spark, path).dtypes)
    assert inferred["arpu_6"] == "double" and inferred["circle_id"] == "int"


def test_csv_cells_of_the_raw_export(spark, tmp_path):
    """Whole numbers written as 1.0, blanks, NaN, unknown metrics and text dates."""
    (tmp_path / "raw.csv").write_text(
        "mobile_number,circle_id,last_date_of_month_6,arpu_6,fb_user_6,date_of_last_rech_6,"
        "count_rech_2g_6,aon\n"
        "7000842753,109,6/30/2014,197.385,1.0,6/21/2014,2,968\n"
        "7001865778,,6/30/2014,NaN,,,,\n"
    )
    df = read_wide_csv(spark, str(tmp_path / "raw.csv"))
    kinds = dict(df.dtypes)
    assert kinds["fb_user_6"] == "int" and kinds["count_rech_2g_6"] == "double"
    assert kinds["date_of_last_rech_6"] == "string" and kinds["mobile_number"] == "bigint"
    first, second = df.orderBy("mobile_number").collect()
    assert (first.fb_user_6, first.aon, first.arpu_6, first.circle_id) == (1, 968, 197.385, "109")
    assert second.arpu_6 is None and second.circle_id is None and second.fb_user_6 is None


def test_declared_wide_table_has_110_columns():
    assert len(wide_schema()) == 110


def test_chart_totals_let_missing_through(spark):
    wide = wide_frame(
        spark,
        [
            {"mobile_number": 1, "circle_id": "a", "total_og_mou_6": 10, "total_ic_mou_6": 5, "arpu_6": 3},
            {"mobile_number": 2, "circle_id": "a", "total_og_mou_6": 10, "total_rech_amt_6": 4},
        ],
    )
    usage = dashboard.chart_usage(wide, months=["2014-06"])
    row = dashboard.dashboard_region_month(usage).first()
    assert (row.avg_calls, row.avg_data, row.total_revenue, row.total_customers) == (15.0, None, 4.0, 2)
    trend = dashboard.dashboard_month_trend(usage).first()
    assert trend.active_users == 1 and trend.avg_arpu == 3.0


def test_chart_sample_is_stable(stored_wide):
    from dataclasses import replace

    from meterwell.settings import DEFAULTS

    small = replace(DEFAULTS, chart_sample_rows=50)
    usage = dashboard.chart_usage(stored_wide)
    same(
        dashboard.dashboard_usage_sample(usage, small),
        dashboard.dashboard_usage_sample(usage.repartition(7), small),
    )
    assert dashboard.dashboard_usage_sample(usage, small).count() == 50


def test_latest_month_only(spark, warehouse):
    root, _ = warehouse
    latest = dashboard.dashboard_latest_rank(read_table(spark, root, RANKING)).collect()
    assert {r.report_month for r in latest} == {"2014-09"} and len(latest) == 25
    scores = [r.composite_score for r in latest]
    known = [s for s in scores if s is not None]
    assert scores == [None] * (25 - len(known)) + sorted(known)


def test_latest_month_needs_no_single_partition(spark, warehouse):
    root, _ = warehouse
    text = plan(dashboard.dashboard_latest_rank(read_table(spark, root, RANKING)))
    assert text.count("SinglePartition") == 1  # the one-row maximum


def test_month_without_rows_ends_up_empty(spark):
    def wide(calls):
        rows = [{"mobile_number": 1, "circle_id": "a", "total_og_mou_8": 100, "total_og_mou_9": calls}]
        return wide_frame(spark, rows)

    root = scratch_dir(spark, "warehouse")
    run_pipeline(wide(0), root)
    before = {n: read_table(spark, root, n) for n in (ALERTS, SILENT)}
    assert [d.filter("report_month = '2014-09'").count() for d in before.values()] == [1, 1]
    others = read_table(spark, root, SILENT).filter("report_month < '2014-09'").count()
    run_pipeline(wide(100), root, months=["2014-09"])
    for name in (ALERTS, SILENT):
        assert read_table(spark, root, name).filter("report_month = '2014-09'").count() == 0
    assert read_table(spark, root, SILENT).count() == others


def test_empty_region_is_a_missing_one(spark):
    root = scratch_dir(spark, "warehouse")
    rows = [{"mobile_number": 1, "circle_id": ""}, {"mobile_number": 2}]
    run_pipeline(wide_frame(spark, rows), root)
    assert [r[0] for r in read_table(spark, root, RAW_TABLE).select("circle_id").collect()] == [None] * 2


def test_csv_columns_match_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("mobile_number,arpu_6,total_og_mou_6\n1,10,20\n")
    (tmp_path / "b.csv").write_text("total_og_mou_6,mobile_number,arpu_6,loc_og_mou_6\n40,2,30,5\n")
    got = {r.mobile_number: r for r in read_wide_csv(spark, str(tmp_path)).collect()}
    assert (got[1].arpu_6, got[1].total_og_mou_6, got[1].loc_og_mou_6) == (10, 20, None)
    assert (got[2].arpu_6, got[2].total_og_mou_6, got[2].loc_og_mou_6) == (30, 40, 5)


def test_csv_cells_that_do_not_fit_are_not_lost(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'mobile_number,arpu_6,aon,circle_id\n1,abc,2,x\n2,"1,200",1.9,y\n3,1.5, 7 ,z\n'
    )
    with pytest.raises(Exception, match="do not fit"):
        read_wide_csv(spark, str(tmp_path)).collect()
    kept = {r.mobile_number: r for r in read_wide_csv(spark, str(tmp_path), bad_cells="keep").collect()}
    assert kept[1]["_bad_cells"] == ["arpu_6"] and kept[2]["_bad_cells"] == ["arpu_6", "aon"]
    assert kept[3]["_bad_cells"] == [] and (kept[3].arpu_6, kept[3].aon) == (1.5, 7)


def test_many_small_files_with_odd_names(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"part {i}.csv").write_text(f"mobile_number,aon\n{i},5\n")
    (tmp_path / "empty.csv").write_text("")
    got = read_wide_csv(spark, str(tmp_path))
    assert got.count() == 300 and got.columns == ["mobile_number", "aon"]
    with gzip.open(tmp_path / "z é.csv.gz", "wt", encoding="utf8") as file:
        file.write("\ufeffaon,mobile_number,arpu_6\n5,777,1.5\n")
    got = read_wide_csv(spark, str(tmp_path))
    assert got.count() == 301
    (row,) = got.filter("mobile_number = 777").collect()
    assert (row.aon, row.arpu_6) == (5, 1.5)


def test_rows_are_counted_while_they_are_written(spark, stored_wide):
    root, written = scratch_dir(spark, "warehouse"), {}
    run_pipeline(stored_wide, root, written=written)
    same(written_counts(spark, written), layer_counts(spark, root))
    one: dict[str, int] = {}
    run_pipeline(stored_wide, root, months=["2014-09"], store_raw=False, written=one)
    assert one[ALERTS] == read_table(spark, root, ALERTS, ["2014-09"]).count()
    assert RAW_TABLE not in one


def test_newest_month_reads_one_partition(spark, warehouse):
    root, _ = warehouse
    latest = read_latest_month(spark, root, RANKING)
    rows = latest.collect()
    assert {r.report_month for r in rows} == {"2014-09"} and len(rows) == 25
    scan = plan(latest).split("Subqueries")[0]
    assert "PartitionFilters: [isnotnull(report_month" in scan and "Subquery" in scan

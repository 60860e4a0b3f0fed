"""The batch job: wide input to warehouse tables and report extracts."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwell.operators.customer import customer_month_kpi
from meterwell.operators.region import region_month_kpi, region_ranking
from meterwell.operators.reshape import wide_to_long
from meterwell.operators.trend import (
    month_over_month,
    silent_customers,
    top_alerts,
    top_silent,
    usage_decline_alerts,
)
from meterwell.schemas import DETAIL_TABLE, RAW_TABLE
from meterwell.settings import DEFAULTS, Settings
from meterwell.sources.extracts import write_extract
from meterwell.sources.tables import read_table, write_table

CUSTOMER_KPI = "dws_customer_monthly_kpi"
REGION_KPI = "dws_circle_monthly_kpi"
RANKING = "ads_circle_performance_ranking"
ALERTS = "ads_usage_decline_alert"
SILENT = "ads_silent_customer_report"

LAYERS = {
    "ods_raw": RAW_TABLE,
    "dwd_long": DETAIL_TABLE,
    "dws_customer_kpi": CUSTOMER_KPI,
    "dws_circle_kpi": REGION_KPI,
    "ads_ranking": RANKING,
    "ads_alerts": ALERTS,
    "ads_silent": SILENT,
}


def run_pipeline(
    wide: DataFrame,
    root: str,
    settings: Settings = DEFAULTS,
    months: Iterable[str] | None = None,
    store_raw: bool = True,
    written: dict[str, int] | None = None,
) -> dict[str, str]:
    """Write every layer below `root`; returns table name -> path.

    Each layer is written once and read back by the next, so the input is read
    once and a lost executor costs only its own tasks. The month-over-month
    reports read the stored wide rows, which hold both months, and so need no
    shuffle by customer. With `months` only those months' partitions of the
    layers after the raw one are replaced, and emptied where nothing is left. Pass
    `store_raw=False` when `wide` is the stored raw table. An empty region is a
    missing one: a folder cannot be named by it. `written` takes the rows that each
    table got, counted while they were written.
    """
    spark = wide.sparkSession
    months = None if months is None else list(months)
    paths: dict[str, str] = {}
    if "circle_id" in wide.columns:
        wide = wide.withColumn("circle_id", F.nullif(F.col("circle_id"), F.lit("")))
    stored = wide
    if store_raw:
        paths[RAW_TABLE] = write_table(wide, root, RAW_TABLE, written=written)
        stored = read_table(spark, root, RAW_TABLE)

    def save(df: DataFrame, name: str, pack: bool = True) -> DataFrame:
        paths[name] = write_table(df, root, name, pack, months, written)
        return read_table(spark, root, name, months)

    def extract(name: str, df: DataFrame) -> None:
        paths[name] = write_extract(df, f"{root.rstrip('/')}/extracts/{name}")

    # Extracts cover every month the tables hold.
    def summaries() -> None:
        long = save(wide_to_long(stored, settings, months), DETAIL_TABLE, pack=False)
        save(customer_month_kpi(long, settings), CUSTOMER_KPI, pack=False)
        kpi = save(region_month_kpi(long, settings), REGION_KPI)
        save(region_ranking(kpi, settings, ordered=False), RANKING)
        ranking = read_table(spark, root, RANKING)
        extract("circle_ranking", ranking.orderBy("report_month", "rank"))

    def declines() -> None:
        compared = month_over_month(stored, settings, months)
        save(usage_decline_alerts(compared, settings, ordered=False), ALERTS)
        extract("decline_alerts", top_alerts(read_table(spark, root, ALERTS), settings))

    def silences() -> None:
        compared = month_over_month(stored, settings, months)
        save(silent_customers(compared, settings, ordered=False), SILENT)
        extract("silent_customers", top_silent(read_table(spark, root, SILENT), settings))

    # Three independent chains from the raw table, submitted side by side so that
    # one chain's last tasks do not leave the cluster idle.
    in_session = inheritable_thread_target(spark)
    chains = [in_session(chain) for chain in (summaries, declines, silences)]
    with ThreadPoolExecutor(len(chains)) as pool:
        for done in [pool.submit(chain) for chain in chains]:
            done.result()
    return paths


def layer_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per stored layer, counted from the written files."""
    counts = [
        read_table(spark, root, name).agg(
            F.lit(layer).alias("layer"), F.count("*").alias("rows")
        )
        for layer, name in LAYERS.items()
    ]
    return reduce(DataFrame.unionByName, [c.select("layer", "rows") for c in counts])


def written_counts(spark: SparkSession, written: dict[str, int]) -> DataFrame:
    """Rows per layer as a run has written them, without reading any of them again."""
    counts = [(layer, written[name]) for layer, name in LAYERS.items() if name in written]
    return spark.createDataFrame(counts, "layer string, rows long")

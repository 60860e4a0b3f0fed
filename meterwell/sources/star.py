"""Subscriber-shaped inputs derived from an order star schema.

Maps `customer`, `orders` and `lineitem` to the wide usage table and `events` to
usage events, so the operators can run on any star-schema data set at any scale.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwell.functions.values import exact_sum
from meterwell.settings import DEFAULTS, Settings

# Order years standing in for months, oldest first: all that the orders span. An order of
# any other year counts in the nearest one.
FIRST_YEAR = 1995
STAR = replace(DEFAULTS, months=tuple((f"_{m}", f"2014-{m:02}") for m in range(3, 10)))

# Whole-number measures, counted from line numbers 1 to 5.
_COUNTS = ("monthly_2g", "monthly_3g", "night_pck_user", "fb_user", "vbc_3g")
_VBC = tuple(f"{m}_vbc_3g" for m in ("mar", "apr", "may", "jun", "jul", "aug", "sep"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item_measures() -> dict[str, str]:
    """Aggregates over the line items of one order, as SQL text."""

    def total(condition: str, times: int) -> str:
        return f"sum(CASE WHEN {condition} THEN l_quantity * {times} END)"

    roamed = "l_linestatus = 'F' AND l_discount >= 0.08D AND l_returnflag"
    third = "l_returnflag = 'A' AND l_linenumber % 3"
    measures = {
        "total_og_mou": total("l_returnflag = 'A'", 10),
        "total_ic_mou": total("l_returnflag = 'R'", 10),
        "roam_og_mou": total(f"{roamed} = 'A'", 1),
        "roam_ic_mou": total(f"{roamed} = 'R'", 1),
        "vol_2g_mb": total("l_returnflag = 'N' AND l_linestatus = 'O'", 20),
        "vol_3g_mb": total("l_returnflag = 'N' AND l_linestatus = 'F'", 20),
    }
    for remainder, name in enumerate(("loc_og_mou", "std_og_mou", "isd_og_mou")):
        measures[name] = total(f"{third} = {remainder}", 10)
    for line, name in enumerate(_COUNTS, start=1):
        measures[name] = f"count_if(l_linenumber = {line})"
    return measures


def wide_usage(spark: SparkSession, sf_dir: str, settings: Settings = STAR) -> DataFrame:
    """One row per customer, one column per metric and month, from every order.

    Line items are reduced to one row per order before they meet the orders. One
    shuffle by customer then serves both the sums per year, the spread into columns
    and the join with the customers. Measures a query does not use are pruned down to
    the scan.
    """
    years = {FIRST_YEAR + i: suffix for i, (suffix, _) in enumerate(settings.months)}
    year = f"greatest({min(years)}, least({max(years)}, year(o_orderdate))) AS year"
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice", year
    )
    items = _item_measures()
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        *(F.expr(f"{c} AS {name}") for name, c in items.items())
    )
    spent = exact_sum("o_totalprice")
    sums = [f"sum({name}) AS {name}" for name in items if name not in _COUNTS]
    counts = [f"CAST(sum(nvl({name}, 0)) AS INT) AS {name}" for name in _COUNTS]
    per_year = (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .repartition("o_custkey")
        .groupBy("o_custkey", "year")
        .agg(
            (spent / 1000).alias("arpu"),
            F.expr("CAST(count(*) AS DOUBLE) AS total_rech_num"),
            spent.alias("total_rech_amt"),
            F.expr("max(o_totalprice) AS max_rech_amt"),
            *(F.expr(c) for c in (*sums, *counts)),
        )
    )
    monthly = [c for c in per_year.columns if c not in ("o_custkey", "year", "vbc_3g")]

    def in_year(value: str, year: int, name: str):
        return F.expr(f"max(CASE WHEN year = {year} THEN {value} END) AS {name}")

    columns = [in_year(c, year, c + suffix) for c in monthly for year, suffix in years.items()]
    for (year, suffix), vbc in zip(years.items(), _VBC):
        columns.append(in_year("vbc_3g", year, vbc))
        columns.append(in_year(f"'{year}-12-31'", year, f"last_date_of_month{suffix}"))
    usage = per_year.groupBy("o_custkey").agg(*columns)
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("mobile_number"),
        F.col("c_nationkey").cast("string").alias("circle_id"),
        (F.col("c_custkey") % 3000).cast("int").alias("aon"),
    )
    return customers.join(usage, F.col("mobile_number") == F.col("o_custkey"), "left").drop(
        "o_custkey"
    )


def star_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage events with an event-time column, from the `events` table."""
    kind, value, event = F.col("event_type"), F.col("value"), F.col("event_id")
    silent = (kind == "error") & (event % 2 == 0)
    signup, fourth = kind == "signup", event % 4 == 0
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("mobile_number"),
        (F.col("user_id") % 5).cast("string").alias("circle_id"),
        F.date_format("ts", "yyyy-MM").alias("report_month"),
        F.when(silent | (signup & fourth), 0.0).otherwise(value).alias("total_calls"),
        F.when(silent | (signup & ~fourth), 0.0).otherwise(value).alias("total_data_mb"),
        (value * 4).alias("arpu"),
        F.when(kind == "purchase", value).otherwise(0.0).alias("total_rech_amt"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )

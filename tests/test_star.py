"""The derived wide table against the tables it comes from."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterwell.sources.star import STAR, table

from conftest import SF_DIR


def test_every_order_and_line_item_counts(spark, stored_wide):
    suffixes = [suffix for suffix, _ in STAR.months]

    def total(metric):
        return sum(F.coalesce(F.sum(metric + s), F.lit(0)) for s in suffixes)

    wide = stored_wide.agg(
        total("total_rech_num").alias("orders"), total("total_rech_amt").alias("spent"),
        total("total_og_mou").alias("og"), total("total_ic_mou").alias("ic"),
        total("vol_2g_mb").alias("g2"), total("vol_3g_mb").alias("g3"),
    ).first()
    orders = table(spark, SF_DIR, "orders").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("p")).first()
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    minutes, data = F.col("l_quantity") * 10, F.col("l_quantity") * 20
    items = table(spark, SF_DIR, "lineitem").agg(
        F.sum(F.when(flag == "A", minutes)).alias("og"), F.sum(F.when(flag == "R", minutes)).alias("ic"),
        F.sum(F.when((flag == "N") & (status == "O"), data)).alias("g2"),
        F.sum(F.when((flag == "N") & (status == "F"), data)).alias("g3"),
    ).first()
    assert wide.orders == orders.n and wide.spent == pytest.approx(orders.p)
    assert (wide.og, wide.ic) == (items.og, items.ic)
    assert (wide.g2 or 0, wide.g3 or 0) == (items.g2 or 0, items.g3 or 0)

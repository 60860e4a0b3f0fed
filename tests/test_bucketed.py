from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meterwell.operators.reshape import wide_to_long
from meterwell.operators.trend import (
    month_over_month,
    month_over_month_bucketed,
    silent_customers,
)
from meterwell.sources.bucketed import bucket_count, write_buckets

from helpers import operators, same, wide_frame


def kept(long, tmp_path, **how):
    return write_buckets(long, str(tmp_path), f"t_{uuid.uuid4().hex}", **how)


def test_pairs_without_a_shuffle(spark, stored_wide, tmp_path):
    usual, crowded = kept(wide_to_long(stored_wide), tmp_path, buckets=4).read(spark)
    assert crowded.isEmpty()
    compared = month_over_month_bucketed(usual, crowded)
    same(compared, month_over_month(stored_wide))
    same(silent_customers(compared, ordered=False), silent_customers(month_over_month(stored_wide)))
    # Below the window of the usual ids there is no exchange; grouping them needs none either.
    alone = month_over_month_bucketed(usual, crowded.filter("false"))
    assert operators(alone, "Window") == 1 and operators(alone, "Exchange") == 0
    assert operators(usual.groupBy("mobile_number").count(), "Exchange") == 0
    # Each bucket is one file.
    assert len(set(usual.inputFiles())) == 4


def test_tables_of_one_key_meet_in_their_buckets(spark, stored_wide, tmp_path):
    long = wide_to_long(stored_wide)
    a, _ = kept(long.filter("report_month = '2014-08'"), tmp_path, buckets=4).read(spark)
    b, _ = kept(long.filter("report_month = '2014-07'"), tmp_path, buckets=4).read(spark)
    met = a.hint("merge").join(b.select("mobile_number", F.col("arpu").alias("before")), "mobile_number")
    assert operators(met, "Exchange") == 0 and operators(met, "SortMergeJoin") == 1
    assert met.count() == long.filter("report_month = '2014-08'").count()


def test_crowded_and_null_ids_are_kept_apart(spark, tmp_path):
    """A third of the rows share an id and a third have none; no row is lost or doubled."""
    rows = [
        {"mobile_number": key, "circle_id": "a", "total_og_mou_6": 10 + i, "total_og_mou_7": 10 + i}
        for i, key in enumerate([7] * 40 + [None] * 40 + list(range(100, 140)))
    ]
    long = wide_to_long(wide_frame(spark, rows), months=["2014-06", "2014-07"])
    made = kept(long, tmp_path, buckets=4, crowd=20)
    usual, crowded = made.read(spark)
    assert usual.count() == 80 and crowded.count() == 160
    assert crowded.select("mobile_number").distinct().count() == 2
    compared = month_over_month_bucketed(usual, crowded)
    same(compared.drop(*[c for c in compared.columns if c.startswith("prev_")]), long.select(
        *[c for c in compared.columns if not c.startswith("prev_")]))
    # Each id has one first row, whatever the number of its rows.
    assert compared.filter("prev_month IS NULL").count() == 42
    plain = kept(long, tmp_path, buckets=4, crowd=10**9).read(spark)
    assert plain[1].isEmpty()
    same(compared, month_over_month_bucketed(*plain))
    made.drop(spark)
    assert not spark.catalog.tableExists(made.usual.strip("`"))


def test_empty_table_and_bucket_numbers(spark, stored_wide, tmp_path):
    none = wide_to_long(stored_wide).filter("false")
    assert month_over_month_bucketed(*kept(none, tmp_path).read(spark)).count() == 0
    assert bucket_count(0) == 8 and bucket_count(16_000_001) == 16
    assert bucket_count(10**12) >= 10**5

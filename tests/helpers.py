from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import DataFrame

# Rows of the two reports over the four default months at the smallest scale.
ALERT_ROWS, SILENT_ROWS = 190, 157

SUFFIXES = ("_6", "_7", "_8", "_9")
METRICS = (
    "arpu", "total_og_mou", "total_ic_mou", "roam_og_mou", "roam_ic_mou", "total_rech_num",
    "total_rech_amt", "vol_2g_mb", "vol_3g_mb",
)


def wide_frame(spark, rows: list[dict], metrics=METRICS) -> DataFrame:
    """Wide rows from dicts of `metric_suffix` values; everything else is null."""
    names = [m + s for m in metrics for s in SUFFIXES]
    ddl = "mobile_number long, circle_id string, aon int, " + ", ".join(f"{n} double" for n in names)
    data = [
        (
            r.get("mobile_number"),
            r.get("circle_id"),
            r.get("aon", 1),
            *(None if r.get(n) is None else float(r[n]) for n in names),
        )
        for r in rows
    ]
    return spark.createDataFrame(data, ddl)


def same(a: DataFrame, b: DataFrame) -> None:
    assert sorted(a.columns) == sorted(b.columns)
    left = sorted((tuple(r[c] for c in sorted(a.columns)) for r in a.collect()), key=repr)
    right = sorted((tuple(r[c] for c in sorted(a.columns)) for r in b.collect()), key=repr)
    assert left == right


def plan(df: DataFrame) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def operators(df: DataFrame, name: str) -> int:
    """How often an operator appears in the plan tree."""
    tree = plan(df).split("\n\n\n")[0]
    return sum(1 for line in tree.splitlines() if name in line)

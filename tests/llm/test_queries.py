"""Every query of the package over the smallest tables: its columns, and its SQL."""

from __future__ import annotations

import duckdb
import pytest

from meterwell.llm.queries import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for name in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    ours = queries()[name](spark, SF_DIR).toPandas()
    theirs = db.execute(oracle_sql()[name]).df()[list(ours.columns)]
    key = ours.columns[0]
    ours, theirs = (f.sort_values(key).reset_index(drop=True) for f in (ours, theirs))
    for column in ours.columns:
        assert ours[column].tolist() == theirs[column].tolist(), column


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries()) == list(range(1, 14))

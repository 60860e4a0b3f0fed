"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import oracle
from check_parity import compare, duck
from meterwell.plans import catalogue

from conftest import SF_DIR


@pytest.fixture(scope="module")
def db():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracle.statements())
    assert set(catalogue.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_equal(spark, db, name):
    assert compare(spark, db, name, SF_DIR) == ""


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 175 and rows[0]["rank"] == 1

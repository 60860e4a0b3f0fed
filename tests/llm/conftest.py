from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"
CLASHING = (
    "id", "row", "h1", "fp", "component", "component_id", "size", "place", "base", "lang_pred",
    "piece", "block", "phrase", "kind", "value", "n", "key", "pos", "range", "shard", "node",
    "gone_id", "gone_h1", "gone_h2", "gone_hash", "gone_lines", "whole_text", "text_key",
    "other_key", "mix_source", "mix_base", "mix_at", "mix_last", "mix_place", "mix_tie",
    "mix_copy", "_mix_copy", "tie", "at", "last", "of", "_h1", "_h2", "_gone", "__id", "__hash",
    "__gone", "__text", "__source", "__place", "__copy", "__key", "GONE_ID", "term", "total", "sha",
)
CLASHING = tuple({name.lower(): name for name in CLASHING}.values())
LONG = "long words go on and on " * 20_000


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    secret = 'password = "abcdEFGH12345678"'
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", None, "b"), (4, LONG, "en", "a"),
        (5, "same text here for all of us to read", "en", "a"),
        (5, "same text here for all of us to read", "en", "a"),
        (6, "same text here for all of us to read", "de", None),
        (None, "same text here for all of us to read", "en", "b"), (None, None, None, None),
        (7, "Ünïcödé " * 30 + secret, "de", "c"), (8, secret + "\nshared line of more than twenty", "en", "b"),
        (9, "x\nShared line of more than twenty \ny", "en", "c"),
        (10, "shared line of more than twenty\nshared line of more than twenty", "en", "c"),
        (11, "one", "en", "a"), (12, "1234 5678", "en", "c"), (13, "🙂 \U0001F600﻿", "en", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *(f"'other' AS `{c}`" for c in CLASHING))


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")

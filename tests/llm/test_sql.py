"""Corpus queries against their SQL twins."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

from barline.llm import oracle, queries

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from check_oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    result = queries.queries()[name](spark, SF_DIR).toPandas()
    assert difference(result, connect(SF_DIR).execute(oracle.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in oracle.oracle_sql()])
def test_query_covers_every_row(spark, name):
    table, key = ("pages", "page_id") if name == "op13_html_text" else ("documents", "doc_id")
    rows = queries.queries()[name](spark, SF_DIR)
    whole = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
    assert rows.select(key).distinct().count() == whole.distinct().count()

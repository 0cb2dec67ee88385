"""Registered queries against their DuckDB statements."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.compare import differences, duck
from tradescribe.sources.schemas import REPORT_COLUMNS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


REPORT_QUERIES = [name for name in entry_points.queries() if name not in entry_points.LLM_QUERIES]


def test_every_query_has_a_statement():
    assert set(REPORT_QUERIES) == set(entry_points.oracle_sql()) - set(entry_points.LLM_STATEMENTS)


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == REPORT_COLUMNS
    assert result.count() == spark.read.parquet(f"{entry_points.SMOKE_DIR}/orders.parquet").count()


@pytest.mark.parametrize("name", REPORT_QUERIES)
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert differences(df, con, entry_points.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", ["buyer_by_nb", "payer_by_nb"])
def test_sorted_by_number(spark, name):
    numbers = [int(row["NB"]) for row in entry_points.queries()[name](spark, SF_DIR).collect()]
    assert numbers == sorted(numbers)

"""Every registered query against its SQL in DuckDB, and the driver contract."""

import pytest

import __spark_entry__ as contract
from checks import QUERIES, SQL
from checks.compare import differences

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert differences(name, spark, FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_yields_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())

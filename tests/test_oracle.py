"""Every registered query against its SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR
from tools.compare import compare, open_oracle


@pytest.fixture(scope="module")
def oracle():
    connection = open_oracle(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_its_sql(spark, oracle: duckdb.DuckDBPyConnection, name):
    verdict, _ = compare(spark, oracle, SF_DIR, name)
    assert not verdict or verdict.startswith("no sql"), verdict


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["order_date", "total_orders_per_day", "total_revenue_per_day"]
    days, orders, revenue = df.selectExpr(
        "count(*)", "sum(total_orders_per_day)", "round(sum(total_revenue_per_day), 2)").first()
    assert (days, orders, revenue) == (1008, 1356, 997768599.00)

"""Every registered query against its SQL twin on the smallest data."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as driver
from tools.parity import compare, connect
from workbench.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def oracle() -> duckdb.DuckDBPyConnection:
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    outcome = compare(spark, oracle, SMALL, name)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns[:4] == ["date_day", "channel", "shipping_city", "customer_segment"]

"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tablework.plans import REGISTERED
from tools.check import compare, oracle_connection

ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_matches_oracle(spark, sf_dir, connection, name):
    run = driver.queries()[name]
    verdict = compare(spark, connection, sf_dir, name, run, ORACLES.get(name))
    assert verdict.startswith("ok"), verdict


def test_entry_returns_rows(spark):
    result = driver.entry(spark)
    assert result.columns == ["segment", "n_orders", "mean_price", "highest_price"]
    assert result.count() == 5


def test_every_query_has_an_oracle():
    assert set(REGISTERED) <= set(ORACLES)


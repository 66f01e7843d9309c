"""Registered queries that SQL can express, and shapes of the others."""

import pytest

from tablework.llm.queries import ORACLES, QUERIES
from tools.check import compare, oracle_connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, sf_dir, name):
    verdict = compare(spark, oracle_connection(sf_dir), sf_dir, name, QUERIES[name], ORACLES[name])
    assert verdict.startswith("ok"), verdict


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))

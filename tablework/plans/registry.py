"""The list of registered queries, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: QueryFunction
    oracle: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under ``name`` beside its oracle SQL, if SQL can express it."""

    def register(function: QueryFunction) -> QueryFunction:
        if name in REGISTERED:
            raise ValueError(f"query {name} is registered twice")
        REGISTERED[name] = Query(function, oracle)
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

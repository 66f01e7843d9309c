"""Row filters by key lists, parameters and positions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.operators.combine import keyed_join


def filter_with(df: DataFrame, condition: str, args: Mapping[str, Any]) -> DataFrame:
    """Filter by an SQL condition with named markers (``:name``) bound to ``args``."""
    return df.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {condition}", dict(args), rows=df)


def keep_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``: the membership test for lists of any length."""
    return keyed_join(df, keys, on, "left_semi")


def remove_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key does not occur in ``keys``; rows without a key stay."""
    return keyed_join(df, keys, on, "left_anti")


def label_slice(df: DataFrame, key: str, first: Any, last: Any) -> DataFrame:
    """Rows with ``first <= key <= last``: both ends belong to a slice by label."""
    return df.filter(F.col(key).between(first, last))


def position_slice(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop - 1`` of ``df`` in the total order ``order``.

    Runs as a top-``stop`` per task and a merge, so only ``stop`` rows leave each task.
    """
    if not 0 <= start <= stop:
        raise ValueError("need 0 <= start <= stop")
    return df.orderBy(*order).offset(start).limit(stop - start)

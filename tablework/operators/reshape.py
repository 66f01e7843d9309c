"""Pivot, unpivot, stack and unstack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """``df``, with an error for a row whose ``column`` is none of ``values``.

    A pivot over named values would leave such rows out without a word.
    """
    message = F.concat(F.lit(f"{column} is not listed: "), F.coalesce(column, F.lit("NULL")))
    listed = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return df.withColumn(column, F.when(listed, F.col(column)).otherwise(F.raise_error(message)))


def pivot_sum(
    df: DataFrame, index: Sequence[str], column: str, values: Sequence[str], summed: str
) -> DataFrame:
    """Sum of ``summed`` per index and pivot value; NULL where there is no row.

    Naming the values saves the pass that would look for them.
    """
    return df.groupBy(*index).pivot(column, list(values)).agg(F.sum(summed))


def stack(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per key and column, without the empty cells."""
    return df.unpivot(list(key), list(columns), name, value).filter(F.col(value).isNotNull())


def unstack(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """The reverse of ``stack``: one row per key, one column per name."""
    return df.groupBy(*key).pivot(name, list(columns)).agg(F.first(value, ignorenulls=True))

"""What SQL writes as correlated and lateral subqueries, as joins and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "rank"


def top_related(
    outer: DataFrame, inner: DataFrame, on: Sequence[str], order: Sequence[Column], k: int, how: str = "inner"
) -> DataFrame:
    """Each outer row with the first ``k`` inner rows of its key, and their ``rank`` from 1.

    Like ``outer, LATERAL (SELECT … FROM inner WHERE key = outer.key ORDER BY … LIMIT k)``; with
    ``how="left"`` outer rows without any stay. Inner rows whose key no outer row has go first (a
    semi-join, so the outer filter prunes the inner scan); ``k`` rows per key and task go through
    the shuffle. ``order`` should be total. NULL keys meet nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"not a lateral join: {how}")
    wanted = outer.select(*on).dropna().distinct()
    place = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
    best = inner.join(wanted, list(on), "left_semi").withColumn(RANK, place).where(F.col(RANK) <= k)
    return outer.join(best, list(on), how)


def beside_aggregates(
    outer: DataFrame, inner: DataFrame, on: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    """Each outer row with aggregates over the inner rows of its key; NULL where there are none.

    Like scalar subqueries that are correlated by equality: one aggregation and one left join.
    """
    totals = inner.groupBy(*on).agg(*aggregates)
    return outer.join(totals, list(on), "left")


def having_related(outer: DataFrame, inner: DataFrame, on: Sequence[str], exists: bool = True) -> DataFrame:
    """Outer rows whose key some inner row has (``EXISTS``), or none (``NOT EXISTS``).

    A NULL key has no related row, so ``NOT EXISTS`` keeps it, unlike ``NOT IN``.
    """
    return outer.join(inner.select(*on), list(on), "left_semi" if exists else "left_anti")

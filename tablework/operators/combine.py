"""Joins on a key, and guarded unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def keyed_join(
    left: DataFrame, right: DataFrame, on: str, how: str = "inner", *, null_safe: bool = False
) -> DataFrame:
    """Join on one key; with ``null_safe`` a NULL key meets NULL keys.

    Spark chooses the strategy by measured sizes and splits the crowded partitions of a hot key
    at run time, so nothing runs before the action. ``how`` is ``inner``, ``left``,
    ``left_semi`` or ``left_anti``; filters after the join may move below it.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a join that the left side decides: {how}")
    if not null_safe:
        return left.join(right, on, how)
    renamed = right.withColumnRenamed(on, "_right_key")
    return left.join(renamed, F.col(on).eqNullSafe(F.col("_right_key")), how).drop("_right_key")


def union_checked(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by position, refused unless names and types agree column by column."""

    def shape(df: DataFrame) -> list[tuple[str, str]]:
        return [(name, kind) for name, kind in df.dtypes]

    if shape(first) != shape(second):
        raise ValueError(f"columns differ: {shape(first)} and {shape(second)}")
    return first.union(second)


def stack_batches(batches: Sequence[DataFrame], tag: str = "batch") -> DataFrame:
    """Stack the rows of several tables, matched by name, each marked with its position."""
    marked = [df.withColumn(tag, F.lit(number)) for number, df in enumerate(batches)]
    result = marked[0]
    for df in marked[1:]:
        result = result.unionByName(df)
    return result

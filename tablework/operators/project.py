"""Projection operators that need more than a single DataFrame method."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.operators.combine import keyed_join


def select_except(df: DataFrame, dropped: Sequence[str]) -> DataFrame:
    """All columns but ``dropped``; unlike ``drop``, an unknown name is an error."""
    unknown = [name for name in dropped if name not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*dropped)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map in one projection; refuses unknown and colliding names."""
    unknown = [old for old in names if old not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    result = [names.get(name, name) for name in df.columns]
    if len(set(result)) != len(result):
        raise ValueError(f"renaming gives equal names: {result}")
    return df.toDF(*result)  # all at once, so that names may be exchanged


def set_where(df: DataFrame, condition: Column, column: str, value: Column) -> DataFrame:
    """Overwrite ``column`` in the rows where ``condition`` holds."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def apply_corrections(
    df: DataFrame, corrections: DataFrame, key: str, column: str
) -> DataFrame:
    """Overwrite ``column`` with the non-NULL value ``corrections`` holds for the row's key.

    ``corrections`` has one row per key. Both sides may be large: Spark broadcasts the
    corrections only if their measured size allows it and shuffles both sides otherwise.
    """
    fixes = corrections.select(F.col(key), F.col(column).alias("_corrected"))
    return (
        keyed_join(df, fixes, key, "left")
        .withColumn(column, F.coalesce("_corrected", column))
        .drop("_corrected")
        .select(df.columns)
    )

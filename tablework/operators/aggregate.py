"""Aggregates, profiles and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.operators.combine import keyed_join


def word_count(df: DataFrame, text: str, word: str = "word", count: str = "n") -> DataFrame:
    """Occurrences of each whitespace-separated word in the whole texts."""
    words = df.select(F.explode(F.split(text, r"\s+")).alias(word)).filter(F.col(word) != "")
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(count))


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per non-NULL value, most frequent first, equal counts by value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.desc(count), F.asc(column))
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (``column_name``, ``nulls``) per column, from one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counted.unpivot([], columns, "column_name", "nulls")


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, from one pass."""
    measures = {
        "n": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "low": F.min,
        "high": F.max,
    }
    profile = df.agg(
        *[
            F.struct(
                *[measure(F.col(name).cast("double")).alias(out) for out, measure in measures.items()]
            ).alias(name)
            for name in columns
        ]
    )
    return profile.unpivot([], list(columns), "column_name", "_m").select("column_name", "_m.*")


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows, number of columns, whether there are no rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        (F.col("n_rows") == 0).alias("is_empty"),
    )


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """Replace NULL in ``column`` by the mean of the column (a scalar subquery, no join)."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def impute_group_mean(df: DataFrame, column: str, group: str) -> DataFrame:
    """Replace NULL in ``column`` by the mean of the row's group.

    The means are aggregated first, so a hot group is never gathered in one task.
    """
    means = df.groupBy(group).agg(F.avg(column).alias("_mean"))
    return (
        keyed_join(df, means, group, "left", null_safe=True)
        .withColumn(column, F.coalesce(F.col(column), F.col("_mean")))
        .select(df.columns)
    )

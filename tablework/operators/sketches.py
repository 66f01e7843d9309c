"""Approximate aggregates that are stored per day and merged for any span.

A day's rows become one row per group: their number, a distinct-count sketch, a quantile sketch and
a frequent-items sketch, each a few kilobytes whatever the number of rows. Spans are answered from
these rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "day"
#: Distinct counts with 2^12 registers: one standard error is 1.04 / 2^6, about 1.6 %.
REGISTERS_LOG = 12
#: Quantile sketches of this size err by less than 1.65 % in rank, at 99 % confidence.
QUANTILE_SIZE = 200
#: Counters of a frequent-items sketch; a count errs by at most the rows by 0.75 times as many.
ITEMS_TRACKED = 2048


def daily_sketches(
    df: DataFrame,
    day: Column,
    groups: Sequence[str],
    *,
    distinct: Column,
    value: Column,
    item: Column,
) -> DataFrame:
    """One row per day and group: ``n_rows, distinct_sketch, value_sketch, item_sketch``.

    Sketches are built where the rows are and merged in the shuffle, so a crowded day or group
    travels as one small row per task. NULLs are in no sketch; ``n_rows`` counts all rows.
    """
    return (
        df.withColumn(DAY, day)
        .groupBy(DAY, *groups)
        .agg(
            F.count("*").alias("n_rows"),
            F.hll_sketch_agg(distinct, REGISTERS_LOG).alias("distinct_sketch"),
            F.kll_sketch_agg_double(value.cast("double"), QUANTILE_SIZE).alias("value_sketch"),
            F.call_function("approx_top_k_accumulate", item, F.lit(ITEMS_TRACKED)).alias("item_sketch"),
        )
    )


def add_days(sketches: DataFrame, path: str) -> None:
    """Store the days of ``sketches``, each a folder; a day that is there already is replaced."""
    (
        sketches.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """The sketches of a span; only the folders of its days are read."""
    stored = spark.read.parquet(path)
    return stored.where(F.col(DAY).between(F.lit(first), F.lit(last)))


def merged(
    sketches: DataFrame, groups: Sequence[str], quantiles: Sequence[float], top: int
) -> DataFrame:
    """Per group ``n_rows``, ``n_distinct``, ``quantiles`` (an array) and ``top_items``, an array of
    items and counts, over all days of ``sketches``. A span without rows has no row."""
    # Frequent items can't be merged over nothing, so a single group is one by a constant.
    together = sketches.groupBy(*(groups or [F.lit(0).alias("_all")])).agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
        F.call_function("approx_top_k_combine", F.col("item_sketch"), F.lit(ITEMS_TRACKED)).alias("item_sketch"),
    )
    ranks = F.array(*[F.lit(float(share)) for share in quantiles])
    return together.select(
        *groups,
        "n_rows",
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        F.kll_sketch_get_quantile_double("value_sketch", ranks).alias("quantiles"),
        F.call_function("approx_top_k_estimate", F.col("item_sketch"), F.lit(top)).alias("top_items"),
    )

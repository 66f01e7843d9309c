"""Tables that start in the program: lookups, empty tables, ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MAX_LOOKUP_ROWS = 10_000


def lookup(
    spark: SparkSession,
    rows: Sequence[tuple] | Sequence[Mapping[str, Any]],
    schema: StructType | str | Sequence[str],
) -> DataFrame:
    """A short table from tuples, mappings or a pandas frame; long ones belong into files."""
    if len(rows) > MAX_LOOKUP_ROWS:
        raise ValueError(f"{len(rows)} rows are too many for a literal table")
    if hasattr(rows, "itertuples"):
        rows = [tuple(row) for row in rows.astype(object).where(rows.notna(), None).values]
    return spark.createDataFrame(list(rows), schema)


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def calendar(days: DataFrame, day: str) -> DataFrame:
    """Every date between the first and the last one in ``days``, made on the executors."""
    first, last = days.agg(F.min(day), F.max(day)).first()
    if first is None:
        return empty(days.sparkSession, "day date")
    length = (last - first).days + 1
    return days.sparkSession.range(0, length, 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )

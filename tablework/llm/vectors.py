"""What the vector searches share: usable vectors, blocks and best rows per query."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """``id, vector, size`` of rows whose vector is a non-empty list of finite numbers.

    Rows without id are left out, and with ``nonzero`` vectors of zeros only. Of rows that share
    an id the smallest vector counts, so repeated rows are one row.
    """
    infinite = float("inf")

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)

    fits = F.forall("vector", finite) & (F.size("vector") > 0)
    if nonzero:
        fits = fits & F.exists("vector", lambda x: x != 0)
    return (
        df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .where(F.coalesce(fits, F.lit(False)))
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("size", F.size("vector"))
    )


def stacked(column) -> np.ndarray:
    """Equally long vectors of a pandas column as a matrix of doubles."""
    return np.stack(column.to_numpy()).astype(np.float64)


def ranked(found: DataFrame, k: int, best_first) -> DataFrame:
    """The first ``k`` rows of each query with their rank; ties go to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(best_first, "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

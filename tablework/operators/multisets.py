"""Set operators that keep multiplicity, by counting equal rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.operators.combine import union_checked
from tablework.operators.rows import key_digest

#: Copies that one step of the expansion makes of a row.
STEP = 10_000


def _counted(first: DataFrame, second: DataFrame) -> DataFrame:
    """Each distinct row with its number in both tables, found by digest; NULLs are equal.

    Equal rows combine before the shuffle, so what travels is one row per distinct row and task.
    """
    for name, kind in first.dtypes:
        if "map<" in kind:
            raise TypeError(f"column {name} holds maps, which have no equality")
    sides = union_checked(
        first.withColumn("_second", F.lit(False)), second.withColumn("_second", F.lit(True))
    )
    # Zero has two signs and one value.
    zeros = {
        name: F.when(F.col(f"`{name}`") == 0, F.lit(0).cast(kind)).otherwise(F.col(f"`{name}`"))
        for name, kind in first.dtypes
        if kind in ("double", "float")
    }
    row = F.struct(*[F.col(f"`{name}`") for name in first.columns]).alias("_row")
    keys = [f"`{name}`" for name in first.columns]
    return (
        sides.withColumns(zeros)
        .select(*key_digest(keys), row, "_second")
        .groupBy("_digest_1", "_digest_2")
        .agg(
            F.any_value("_row").alias("_row"),
            F.count_if(~F.col("_second")).alias("_n_first"),
            F.count_if("_second").alias("_n_second"),
        )
    )


def _expanded(counted: DataFrame, copies: Column) -> DataFrame:
    """Each row as often as ``copies`` says, in steps of bounded size."""
    steps = F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {STEP}"))
    left = F.least(F.col("_copies") - F.col("_step") * STEP, F.lit(STEP))
    return (
        counted.withColumn("_copies", copies)
        .where("_copies > 0")
        .select("_row", "_copies", F.explode(steps).alias("_step"))
        .select("_row", F.explode(F.sequence(F.lit(1), left.cast("int"))).alias("_copy"))
        .select("_row.*")
    )


def intersect_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows in both tables, each as often as in the one that has fewer of it."""
    return _expanded(_counted(first, second), F.least("_n_first", "_n_second"))


def except_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of ``first``, each as often as it is there more often than in ``second``."""
    return _expanded(_counted(first, second), F.col("_n_first") - F.col("_n_second"))

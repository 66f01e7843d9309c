"""Aggregates over all pairs with ``a < b``, without making the pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.operators.windows import CHUNK, with_chunks


def aggregate_below(
    left: DataFrame,
    right: DataFrame,
    left_value: str,
    right_value: str,
    measure: str,
    *,
    on: Sequence[str] = (),
    or_equal: bool = False,
    above: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Per left row the number, sum, minimum and maximum of ``measure`` over the right rows with
    ``right_value < left_value``.

    With ``or_equal`` equal values count, with ``above`` the larger values do instead. The result
    has ``n_below``, ``sum_below``, ``min_below`` and ``max_below`` (``…_above``) beside all left
    columns; ``n`` counts rows, the others leave out NULL measures and are NULL over nothing. NULL
    values and keys meet nothing, and NaN is the largest value, as Spark sorts it.

    The pairs are never made: both tables are range-partitioned by key and value together, right rows
    of one value are added up first, running aggregates go over each chunk, and one row per chunk
    carries what the earlier chunks of the key hold. Sums of decimals and whole numbers are exact;
    those of doubles depend on the order of adding within rounding.
    """
    keys = [f"_key_{i}" for i in range(len(on))]
    names = {name: f"{name}_{'above' if above else 'below'}" for name in ("n", "sum", "min", "max")}
    taken = {name.lower() for name in left.columns}
    clash = sorted(name for name in names.values() if name in taken)
    if clash:
        raise ValueError(f"the table has columns {clash} already")

    value = F.col(f"`{right_value}`").alias("_value")
    parts = (
        right.dropna(subset=list(on))
        .where(value.isNotNull())
        .groupBy(*[F.col(f"`{name}`").alias(key) for name, key in zip(on, keys)], value)
        .agg(
            F.count("*").alias("_n"),
            F.sum(f"`{measure}`").alias("_sum"),
            F.min(f"`{measure}`").alias("_min"),
            F.max(f"`{measure}`").alias("_max"),
        )
        .withColumns({"_side": F.lit(0 if or_equal else 1), "_tie": F.lit(0).cast("long")})
    )
    row = F.struct(*[F.col(f"`{name}`") for name in left.columns])
    asking = left.select(
        *[F.col(f"`{name}`").alias(key) for name, key in zip(on, keys)],
        F.col(f"`{left_value}`").alias("_value"),
        row.alias("_row"),
        F.lit(1 if or_equal else 0).alias("_side"),
        F.xxhash64(F.to_json(row)).alias("_tie"),
    )
    both = parts.unionByName(asking, allowMissingColumns=True)
    order = ["-_value" if above else "_value", "_side", "_tie"]
    chunked = with_chunks(both, keys, order, chunks).withColumn("_carried", F.lit(0))

    running = {"_n": F.sum, "_sum": F.sum, "_min": F.min, "_max": F.max}
    totals = chunked.groupBy(*keys, CHUNK).agg(*[f(name).alias(name) for name, f in running.items()])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, CHUNK, F.lit(-1).alias("_carried"),
        *[f(name).over(earlier).alias(name) for name, f in running.items()],
    ).where("_n IS NOT NULL")
    walk = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy("_carried", F.desc("_value") if above else F.asc("_value"), "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    met = chunked.unionByName(carried, allowMissingColumns=True).select(
        "_row", "_value", *[f(name).over(walk).alias(name) for name, f in running.items()]
    ).where("_row IS NOT NULL")
    known = F.col("_value").isNotNull()
    return met.select(
        *[F.col(f"_row.`{name}`").alias(name) for name in left.columns],
        F.when(known, F.coalesce("_n", F.lit(0))).otherwise(0).cast("long").alias(names["n"]),
        *[F.when(known, F.col(f"_{name}")).alias(names[name]) for name in ("sum", "min", "max")],
    )

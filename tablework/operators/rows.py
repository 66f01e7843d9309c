"""Duplicates, orderings, slices and samples of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_digest(keys: Sequence[str]) -> list[Column]:
    """128 bits of hash of the key values, NULL told apart, as two short grouping columns."""
    absent = [F.col(name).isNull() for name in keys]
    return [
        F.xxhash64(*absent, *keys).alias("_digest_1"),
        F.xxhash64(F.lit(1), *keys, *absent).alias("_digest_2"),
    ]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key group in the total order ``order``.

    A minimum over structs, so each task keeps one row per key before the shuffle and a group
    of copies of any size shrinks to one row per task. Rows are grouped by a digest of the key,
    so that long texts are neither sorted nor compared; groups of more than one key value, which
    the digest would have to make equal, raise an error.
    """
    rest = [name for name in df.columns if name not in order]
    ranked = F.struct(*order, *rest)
    check = F.hash(*[F.col(name).isNull() for name in keys], *keys)
    picked = df.groupBy(*key_digest(keys)).agg(
        F.min(ranked).alias("_row"), F.min(check).alias("_low"), F.max(check).alias("_high")
    )
    checked = picked.withColumn(
        "_row",
        F.when(F.col("_low") == F.col("_high"), F.col("_row")).otherwise(
            F.raise_error(F.lit("two keys with one digest"))
        ),
    )
    return checked.select("_row.*").select(df.columns)


def flag_duplicates(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], flag: str = "is_duplicate"
) -> DataFrame:
    """Mark every row that repeats ``columns`` of an earlier row in the total order ``order``.

    The first rows are found by aggregation on a digest of ``columns`` and matched back on
    ``order``, which is unique and may hold NULL, so a large group of copies does not meet in
    one task.
    """
    firsts = (
        df.groupBy(*key_digest(columns))
        .agg(F.min(F.struct(*order)).alias("_first"))
        .select(
            *[F.col(f"_first.{name}").alias(f"_first_{i}") for i, name in enumerate(order)],
            F.lit(False).alias("_repeat"),
        )
    )
    same = F.lit(True)
    for i, name in enumerate(order):
        same = same & F.col(name).eqNullSafe(F.col(f"_first_{i}"))
    return (
        df.join(firsts, same, "left")
        .withColumn(flag, F.coalesce(F.col("_repeat"), F.lit(True)))
        .select(*df.columns, flag)
    )


def last_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows in the total order ``order``, found as a top-n from the other end."""
    return df.orderBy(*[F.desc(name) for name in order]).limit(n)


def category_rank(column: str, categories: Sequence[str]) -> Column:
    """Position of the value in ``categories`` (from 1), NULL for any other value."""
    position = F.array_position(F.array(*[F.lit(name) for name in categories]), F.col(column))
    return F.nullif(position, F.lit(0))


def category_at_least(column: str, categories: Sequence[str], bound: str) -> Column:
    """Whether the value stands at or behind ``bound`` in ``categories``; NULL for other values."""
    return category_rank(column, categories) >= F.lit(list(categories).index(bound) + 1)


def sort_by_category(
    df: DataFrame, column: str, categories: Sequence[str], key: Sequence[str]
) -> DataFrame:
    """Sort in category order; ``key`` makes the order total and lets a hot category split."""
    return df.orderBy(category_rank(column, categories).asc_nulls_last(), *key)


def sample_by_key(df: DataFrame, key: str, share: float) -> DataFrame:
    """About ``share`` of the rows, always the same ones: those whose key hashes low."""
    if share >= 1:
        return df
    limit = f"{int(share * 2**32):08x}"
    return df.filter(F.substring(F.md5(F.col(key).cast("string")), 1, 8) < limit)

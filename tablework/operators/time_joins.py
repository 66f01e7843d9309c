"""Joins by nearness in time and by overlap, without comparing all rows of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampNTZType, TimestampType

from tablework.operators.windows import CHUNK, with_chunks


def _refuse_shared_names(left: DataFrame, right: Sequence[str]) -> None:
    taken = {name.lower() for name in left.columns}
    shared = sorted(name for name in right if name.lower() in taken)
    if shared:
        raise ValueError(f"both tables have columns {shared}; rename them first")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    direction: str = "backward",
    strict: bool = False,
    tolerance: Column | None = None,
    how: str = "left",
    chunks: int | None = None,
) -> DataFrame:
    """Each left row with the last right row of its key up to its time (``backward``), or with the
    first one from its time on (``forward``).

    With ``strict`` equal times don't count, and ``tolerance`` is the largest difference, as an
    interval or number. ``how`` is ``left`` or ``inner``. NULL keys and times meet nothing. Of right
    rows of one time the greatest (backward) or smallest (forward) row by its columns in order is
    taken, so these must have an order.

    Both tables are range-partitioned by key and time together, so that a hot key is cut into
    chunks. Within a chunk the row to take is a running maximum; the last row of the earlier
    chunks of a key comes from one maximum per chunk and enters each chunk as one more row. Equal
    rows of one key and time are cut by a hash.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError(f"unknown direction or join: {direction}, {how}")
    backward = direction == "backward"
    payload = [name for name in right.columns if name not in on]
    _refuse_shared_names(left, payload)
    keys = [f"_key_{i}" for i in range(len(on))]
    best = F.max if backward else F.min

    # The right rows of a time come before the left ones in the direction of the walk, unless strict.
    def rows(df: DataFrame, time: str, is_left: bool, row: Column) -> DataFrame:
        nothing = F.lit(None)
        return df.select(
            *[F.col(f"`{name}`").alias(key) for name, key in zip(on, keys)],
            F.col(f"`{time}`").alias("_time"),
            F.lit(int(is_left != strict)).alias("_side"),
            (row if is_left else nothing).alias("_left"),
            (nothing if is_left else row).alias("_right"),
            F.lit(is_left).alias("_asks"),
            F.xxhash64(F.to_json(row)).alias("_tie"),
        )

    left_row = F.struct(*[F.col(f"`{name}`") for name in left.columns])
    # The time comes first, so that the greatest row is the latest one.
    right_row = F.struct(
        F.col(f"`{right_time}`").alias("_at"), *[F.col(f"`{name}`") for name in payload]
    )
    usable = right.dropna(subset=[*on, right_time])
    both = rows(left, left_time, True, left_row).unionByName(
        rows(usable, right_time, False, right_row)
    )
    order = ["_time", "_side", "_tie"] if backward else ["-_time", "_side", "_tie"]
    chunked = with_chunks(both, keys, order, chunks).withColumn("_carried", F.lit(0))

    lasts = chunked.groupBy(*keys, CHUNK).agg(best("_right").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.withColumn("_right", best("_last").over(earlier)).where("_right IS NOT NULL")
    carried = carried.select(
        *keys, CHUNK, "_right", F.lit(False).alias("_asks"), F.lit(-1).alias("_carried")
    )
    walk = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy("_carried", F.asc("_time") if backward else F.desc("_time"), "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    met = chunked.unionByName(carried, allowMissingColumns=True).withColumn(
        "_met", best("_right").over(walk)
    )
    fits = F.col("_time").isNotNull()
    if tolerance is not None:
        apart = F.col("_time") - F.col("_met._at") if backward else F.col("_met._at") - F.col("_time")
        fits = fits & F.coalesce(apart <= tolerance, F.lit(False))
    met = met.where("_asks").withColumn("_met", F.when(fits, F.col("_met")))
    if how == "inner":
        met = met.where("_met IS NOT NULL")
    return met.select(
        *[F.col(f"_left.`{name}`").alias(name) for name in left.columns],
        *[F.col(f"_met.`{name}`").alias(name) for name in payload],
    )


def _whole_number(df: DataFrame, name: str) -> Column:
    """Times as microseconds, dates as days, whole numbers as they are."""
    kind = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    if kind.typeName() == "date":
        return F.unix_date(column).cast("long")
    if isinstance(kind, NumericType) and kind.typeName() in ("byte", "short", "integer", "long"):
        return column.cast("long")
    raise TypeError(f"intervals need times, dates or whole numbers, and {name} is {kind.typeName()}")


def _filed(
    df: DataFrame, span: tuple[str, str], on: Sequence[str], side: str, half_open: bool
) -> DataFrame:
    """Key, bounds and level of each interval beside its row; those that can't meet any go."""
    start, end = (_whole_number(df, name) for name in span)
    last = end - 1 if half_open else end
    length = F.col(f"{side}_last") - F.col(f"{side}_start")
    return (
        df.dropna(subset=[*on, *span])
        .select(
            *[F.col(f"`{name}`").alias(f"_key_{i}") for i, name in enumerate(on)],
            start.alias(f"{side}_start"),
            last.alias(f"{side}_last"),
            F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias(f"{side}_row"),
        )
        .where(length >= 0)
        # The least number of bits whose power of two is not below the length.
        .withColumn(
            f"{side}_level", F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
        )
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    *,
    on: Sequence[str] = (),
    half_open: bool = False,
) -> DataFrame:
    """All pairs of rows whose intervals share a point, and whose keys in ``on`` are equal.

    Spans name the columns of start and end: times, dates or whole numbers. A point is an interval
    that starts where it ends, so this is the range join too. Ends belong to the interval unless
    ``half_open``. NULL keys or bounds and intervals that end before they start meet nothing. The
    right table's ``on`` columns are left out of the result.

    An interval's level is the power of two its length fits into, and buckets of its level are that
    wide, so it lies in at most two of them. Two intervals meet at the higher of their levels: each is
    filed under its own level and under the higher ones that the other table has, of which there are at
    most 63 (measured by one aggregation). Long intervals thus never meet short ones in narrow
    buckets. A pair comes from the bucket where the common part begins, so it comes once. The join
    is a plain equi-join on key, level and bucket, whose crowded partitions Spark splits.
    """
    _refuse_shared_names(left, [name for name in right.columns if name not in on])
    a = _filed(left, left_span, on, "_a", half_open)
    b = _filed(right, right_span, on, "_b", half_open)
    levels = {
        side: sorted(row[0] for row in df.select(f"{side}_level").distinct().collect())
        for side, df in (("_a", a), ("_b", b))
    }

    def in_buckets(df: DataFrame, side: str, level: Column) -> DataFrame:
        buckets = [
            F.call_function("shiftright", F.col(f"{side}_{end}"), F.col("_level"))
            for end in ("start", "last")
        ]
        return df.withColumn("_level", level).withColumn(
            "_bucket", F.explode(F.array_distinct(F.array(*buckets)))
        )

    def at_own_level(df: DataFrame, side: str) -> DataFrame:
        return in_buckets(df, side, F.col(f"{side}_level"))

    def at_levels(df: DataFrame, side: str, other: str, with_own: bool) -> DataFrame:
        listed = F.array(*[F.lit(level).cast("int") for level in levels[other]]).cast("array<int>")
        own = F.col(f"{side}_level")
        above = F.filter(listed, lambda level: level >= own if with_own else level > own)
        return in_buckets(df, side, F.explode(above))

    place = [*(f"_key_{i}" for i in range(len(on))), "_level", "_bucket"]
    later = F.greatest("_a_start", "_b_start")
    begins_here = F.call_function("shiftright", later, F.col("_level")) == F.col("_bucket")
    overlap = later <= F.least("_a_last", "_b_last")

    def pairs(one: DataFrame, two: DataFrame) -> DataFrame:
        return one.join(two, place).where(overlap & begins_here).select("_a_row", "_b_row")

    met = pairs(at_own_level(a, "_a"), at_levels(b, "_b", "_a", True)).unionAll(
        pairs(at_levels(a, "_a", "_b", False), at_own_level(b, "_b"))
    )
    return met.select(
        *[F.col(f"_a_row.`{name}`").alias(name) for name in left.columns],
        *[F.col(f"_b_row.`{name}`").alias(name) for name in right.columns if name not in on],
    )

"""Exact percentiles without sorting a column or gathering it in one task.

A quantile sketch of all columns bounds the values around every wanted rank. The rows inside
these bounds, a fixed small share whatever the distribution is, are counted per value and
written; what lies below the bounds is only counted. The ranks are then found among the written
values, with further sketches until few enough are left for the driver. The table itself is read
three times.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.workspace import checkpointed

#: A sketch places a value within this share of the rows; bounds are taken three times as wide.
ACCURACY = 10_000
#: Columns with fewer rows lie inside their bounds as a whole, where a sketch is coarser than a rank.
SHORT = 5 * ACCURACY
#: Distinct values that the driver may look through.
FEW_VALUES = 100_000
#: Where the values between are cut while they are more.
CUTS = [i / 100 for i in range(1, 100)]


@dataclass
class Rank:
    """The value at ``rank`` (0-based) of a column lies in [low, high]; ``below`` are less."""

    column: str
    rank: int
    low: float
    high: float
    below: int = 0


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float]
) -> DataFrame:
    """Rows (``column_name``, ``share``, ``value``), interpolated linearly between neighbours.

    NULL and NaN are left out. A column without values gives NULL. Infinite values rank below or
    above all others; between them and a finite value lies the infinite one, and between both NaN.
    """
    spark = df.sparkSession
    values = df.select(*[_numbers(name) for name in columns])
    sizes, bounds = _bounds(values, columns, shares)
    ranks = [
        Rank(name, rank, *bounds[name][1][share])
        for name in bounds
        for share in shares
        for rank in sorted(set(_neighbours(share, sizes[name])))
    ]
    at = _search(values, ranks)
    result = []
    for name in columns:
        for share in shares:
            value = None
            if name in bounds:
                position = share * (sizes[name] - 1)
                under, over = _neighbours(share, sizes[name])
                low, high = at[name, under], at[name, over]
                value = _between(low, high, position - under)
            result.append((name, float(share), value))
    return spark.createDataFrame(result, "column_name string, share double, value double")


def _numbers(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value).alias(name)


def _neighbours(share: float, n: int) -> tuple[int, int]:
    position = share * (n - 1)
    return math.floor(position), math.ceil(position)


def _between(low: float, high: float, part: float) -> float:
    if part == 0 or low == high:
        return low
    if math.isinf(low) or math.isinf(high):
        return low + high
    return low + (high - low) * part


def _around(share: float) -> list[float]:
    return [max(0.0, share - 3 / ACCURACY), min(1.0, share + 3 / ACCURACY)]


def _bounds(values: DataFrame, columns: Sequence[str], shares: Sequence[float]):
    """One pass: sizes, and per column its ends and the bounds around each share."""
    around = [edge for share in shares for edge in _around(share)]
    measures = []
    for name in columns:
        measures += [
            F.count(name).alias(f"n_{name}"),
            F.min(name).alias(f"low_{name}"),
            F.max(name).alias(f"high_{name}"),
            F.percentile_approx(name, around, ACCURACY).alias(f"at_{name}"),
        ]
    row = values.agg(*measures).first()
    sizes, bounds = {}, {}
    for name in columns:
        sizes[name] = row[f"n_{name}"]
        if not sizes[name]:
            continue
        low, high, found = row[f"low_{name}"], row[f"high_{name}"], row[f"at_{name}"]
        pairs = {}
        for i, share in enumerate(shares):
            wide = [0.0, 1.0] if sizes[name] < SHORT else _around(share)
            pairs[share] = (
                low if wide[0] == 0.0 else found[2 * i],
                high if wide[1] == 1.0 else found[2 * i + 1],
            )
        bounds[name] = ((low, high), pairs)
    return sizes, bounds


def _search(values: DataFrame, ranks: list[Rank]) -> dict[tuple[str, int], float]:
    """The value at each rank."""
    stretches = sorted({(r.column, r.low, r.high) for r in ranks})
    if not stretches:
        return {}
    below = values.agg(
        *[F.count_if(F.col(name) < low).alias(f"b{i}") for i, (name, low, _) in enumerate(stretches)]
    ).first()
    inside = F.array(
        *[
            F.when(
                F.col(name).between(low, high),
                F.struct(F.lit(i).alias("stretch"), F.col(name).alias("value")),
            )
            for i, (name, low, high) in enumerate(stretches)
        ]
    )
    counted = checkpointed(
        values.select(F.explode(F.filter(inside, lambda item: item.isNotNull())).alias("item"))
        .groupBy("item.stretch", "item.value")
        .agg(F.count(F.lit(1)).alias("n")),
        "percentiles",
    )
    at = {}
    few = None
    if counted.count() <= FEW_VALUES:
        few = sorted(counted.select("stretch", "value", "n").collect())
    for i, stretch in enumerate(stretches):
        own = [row[1:] for row in few if row[0] == i] if few is not None else None
        for r in ranks:
            if (r.column, r.low, r.high) == stretch:
                rank = r.rank - below[i]
                rows = counted.where(F.col("stretch") == i)
                at[r.column, r.rank] = _at_rank(own, rank) if own is not None else _pick(rows, rank)
    return at


def _at_rank(rows: list[tuple[float, int]], rank: int) -> float:
    for value, n in rows:
        if rank < n:
            return value
        rank -= n
    raise AssertionError("a sketch has missed a rank")


def _pick(counted: DataFrame, rank: int) -> float:
    """The value at ``rank`` among distinct values with their numbers of rows."""
    while counted.count() > FEW_VALUES:
        cuts = counted.agg(F.percentile_approx("value", CUTS, ACCURACY)).first()[0]
        weights = [
            F.coalesce(F.sum(F.when(F.col("value") < cut, F.col("n"))), F.lit(0)) for cut in cuts
        ]
        before = counted.agg(*[w.alias(f"w{i}") for i, w in enumerate(weights)]).first()
        first = max((i for i, weight in enumerate(before) if weight <= rank), default=None)
        if first is not None:
            counted = counted.where(F.col("value") >= cuts[first])
            rank -= before[first]
        following = 0 if first is None else first + 1
        if following < len(cuts):
            counted = counted.where(F.col("value") < cuts[following])
    return _at_rank(sorted(tuple(row) for row in counted.select("value", "n").collect()), rank)

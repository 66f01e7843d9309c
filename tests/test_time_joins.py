"""As-of, interval and theta joins against all pairs, with a hot key cut into many chunks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablework.operators.theta import aggregate_below
from tablework.operators.time_joins import asof_join, interval_join

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sides():
    """Two thirds of the rows have key 1; times repeat, and keys and times are NULL here and there."""
    dice = random.Random(21)

    def rows(n, first):
        for i in range(first, first + n):
            key = dice.choice([1, 1, 1, 1, 2, 3, None])
            yield key, dice.choice([None, *range(60), *range(60)]), i

    return list(rows(300, 0)), list(rows(200, 1000))


@pytest.fixture(scope="module")
def tables(spark, sides):
    left = spark.createDataFrame(sides[0], "k long, t long, a long").repartition(3)
    right = spark.createDataFrame(sides[1], "k long, u long, b long").repartition(3)
    return left, right


def as_of(sides, backward, strict, tolerance):
    for k, t, a in sides[0]:
        near = [
            (u, b)
            for k2, u, b in sides[1]
            if None not in (k, t, u)
            and k2 == k
            and (u < t or (u == t and not strict) if backward else u > t or (u == t and not strict))
        ]
        best = (max if backward else min)(near, default=None)
        if best and tolerance is not None and abs(best[0] - t) > tolerance:
            best = None
        yield (k, t, a, *(best or (None, None)))


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 2])
def test_asof_join_across_chunks(rows_of, sides, tables, direction, strict, tolerance):
    found = asof_join(
        *tables, ["k"], "t", "u", direction=direction, strict=strict, chunks=9,
        tolerance=None if tolerance is None else F.lit(tolerance),
    )
    expected = list(as_of(sides, direction == "backward", strict, tolerance))
    assert rows_of(found) == sorted(expected, key=str)
    inner = asof_join(
        *tables, ["k"], "t", "u", direction=direction, strict=strict, how="inner",
        tolerance=None if tolerance is None else F.lit(tolerance),
    )
    assert rows_of(inner) == sorted((row for row in expected if row[-1] is not None), key=str)


def test_asof_join_of_empty_tables_and_shared_names(tables):
    left, right = tables
    assert asof_join(left.limit(0), right, ["k"], "t", "u").count() == 0
    alone = asof_join(left, right.limit(0), ["k"], "t", "u")
    assert alone.where("b IS NULL").count() == left.count()
    with pytest.raises(ValueError, match="rename"):
        asof_join(left, left, ["k"], "t", "t")
    with pytest.raises(ValueError, match="nearest"):
        asof_join(left, right, ["k"], "t", "u", direction="nearest")


def test_a_hot_key_of_an_asof_join_is_cut(spark):
    """All rows have one key: no task of the windows holds them all."""
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    right = spark.range(0, 4000, 7).select(F.lit(1).alias("k"), F.col("id").alias("u"))
    from tablework.operators.windows import CHUNK, with_chunks

    sizes = with_chunks(left, ["k"], ["t"], 8).groupBy(CHUNK).count().collect()
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 1500
    found = asof_join(left, right, ["k"], "t", "u", chunks=8)
    assert found.where("u <> t - t % 7 OR u IS NULL").count() == 0


def intervals(dice, n, first):
    for i in range(first, first + n):
        a = dice.randrange(-3000, 3000)
        length = dice.choice([0, 0, 1, 2, 3, 8, 9, 64, 700, 5000, -4])
        yield dice.choice([1, 1, 1, 2, None]), dice.choice([a, a, a, None]), a + length, i


@pytest.fixture(scope="module")
def spans(spark):
    dice = random.Random(22)
    one, two = list(intervals(dice, 250, 0)), list(intervals(dice, 200, 1000))
    left = spark.createDataFrame(one, "k long, a long, b long, i long").repartition(3)
    right = spark.createDataFrame(two, "k long, c long, d long, j long").repartition(3)
    return one, two, left, right


@pytest.mark.parametrize("half_open", [False, True])
@pytest.mark.parametrize("keyed", [False, True])
def test_interval_join_against_all_pairs(rows_of, spans, half_open, keyed):
    one, two, left, right = spans
    ends = 1 if half_open else 0
    expected = [
        (k, a, b, i, *((c, d, j) if keyed else (k2, c, d, j)))
        for k, a, b, i in one
        for k2, c, d, j in two
        if None not in (a, c) and a <= b - ends and c <= d - ends
        and max(a, c) <= min(b, d) - ends and (not keyed or (k is not None and k == k2))
    ]
    if not keyed:
        right = right.withColumnRenamed("k", "k2")
    found = interval_join(
        left, right, ("a", "b"), ("c", "d"), on=["k"] if keyed else [], half_open=half_open
    )
    assert len(expected) > 500
    assert rows_of(found) == sorted(expected, key=str)


def test_points_times_dates_and_other_types(spark, rows_of):
    points = spark.createDataFrame([(1, START), (2, START + timedelta(days=40))], "p long, at timestamp_ntz")
    ranges = spark.createDataFrame(
        [(7, START - timedelta(days=300), START), (8, START, START + timedelta(microseconds=1))],
        "r long, s timestamp_ntz, e timestamp_ntz",
    )
    met = interval_join(points, ranges, ("at", "at"), ("s", "e")).select("p", "r")
    assert rows_of(met) == [(1, 7), (1, 8)]
    dated = ranges.select("r", F.to_date("s").alias("s"), F.to_date("e").alias("e"))
    days = points.select("p", F.to_date("at").alias("at"))
    assert rows_of(interval_join(days, dated, ("at", "at"), ("s", "e")).select("p", "r")) == [(1, 7), (1, 8)]
    with pytest.raises(TypeError, match="double"):
        interval_join(points, ranges.select(F.lit(1.0).alias("s"), F.lit(2.0).alias("e")), ("at", "at"), ("s", "e"))


def test_interval_join_makes_no_more_pairs_than_it_must(spark):
    """Many short intervals and a few long ones: what the join tries stays near what it returns."""
    short = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") + 2).alias("b"))
    other = spark.range(20_000).select((F.col("id") + 1).alias("c"), (F.col("id") + 2).alias("d"))
    long = spark.range(3).select((F.col("id") * 5000).alias("c"), (F.col("id") * 5000 + 4000).alias("d"))
    met = interval_join(short, other.unionAll(long), ("a", "b"), ("c", "d"))
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert met.count() == sum(
        len(range(max(1, a - 1), min(20_000, a + 2) + 1)) for a in range(20_000)
    ) + sum(sum(a <= c + 4000 and a + 2 >= c for a in range(20_000)) for c in (0, 5000, 10_000))


@pytest.mark.parametrize("above", [False, True])
@pytest.mark.parametrize("or_equal", [False, True])
def test_theta_aggregates_against_all_pairs(rows_of, sides, tables, above, or_equal):
    left, right = tables
    measured = right.withColumn("m", F.when(F.col("b") % 5 > 0, F.col("b")))
    expected = []
    for k, t, a in sides[0]:
        met = [
            b if b % 5 else None
            for k2, u, b in sides[1]
            if None not in (k, t, u) and k == k2 and ((u > t if above else u < t) or (or_equal and u == t))
        ]
        known = [m for m in met if m is not None]
        expected.append((k, t, a, len(met), sum(known) if known else None, min(known, default=None), max(known, default=None)))
    found = aggregate_below(left, measured, "t", "u", "m", on=["k"], or_equal=or_equal, above=above, chunks=9)
    assert rows_of(found) == sorted(expected, key=str)


def test_theta_over_nothing(tables):
    left, right = tables
    assert aggregate_below(left, right.limit(0), "t", "u", "b").where("n_below = 0 AND sum_below IS NULL").count() == 300
    assert aggregate_below(left.limit(0), right, "t", "u", "b").count() == 0
    with pytest.raises(ValueError, match="already"):
        aggregate_below(left.withColumn("n_below", F.lit(1)), right, "t", "u", "b")

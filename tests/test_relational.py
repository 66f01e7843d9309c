"""Sketches, multisets, subqueries and recursion on small tables."""

import random
from collections import Counter, deque
from datetime import date

import pytest
from pyspark.sql import functions as F

from tablework.operators import multisets, sketches
from tablework.operators.multisets import except_all, intersect_all
from tablework.operators.recursion import paths, reachable
from tablework.operators.subqueries import beside_aggregates, having_related, top_related
from tablework.plans import REGISTERED
from tablework.workspace import new_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark):
    dice = random.Random(41)
    numbers = [0.0, -0.0, 1.5, float("nan"), None]

    def rows(n):
        return [(dice.choice([1, 2, None]), dice.choice(["a", "", None]), dice.choice(numbers)) for _ in range(n)]

    schema = "k long, s string, x double"
    return [spark.createDataFrame(rows(n), schema).repartition(3) for n in (400, 300)]


def counted(df):
    return Counter(str(tuple(row)).replace("-0.0", "0.0") for row in df.collect())


def test_multisets_like_the_built_in_ones(sides, monkeypatch):
    monkeypatch.setattr(multisets, "STEP", 7)
    one, two = sides
    assert counted(intersect_all(one, two)) == counted(one.intersectAll(two))
    assert counted(except_all(one, two)) == counted(one.exceptAll(two))
    assert except_all(one, one).count() == 0 and intersect_all(one, two.limit(0)).count() == 0
    assert counted(except_all(one, two.limit(0))) == counted(one)


def test_many_copies_and_refused_tables(spark, sides):
    many = spark.range(30_000).select(F.lit(1).alias("k"))
    assert except_all(many, many.limit(4321)).count() == 30_000 - 4321
    with pytest.raises(ValueError, match="columns differ"):
        except_all(sides[0], many)
    with pytest.raises(TypeError, match="maps"):
        maps = many.select(F.create_map("k", "k").alias("m"))
        intersect_all(maps, maps)


def test_days_are_sketched_once_and_replaced(spark):
    path = new_path(spark, "sketches")

    def add(first, last, shift=0):
        rows = spark.range(first, last).select(
            "id", F.expr(f"date_add(DATE'2024-01-01', CAST(id % 4 AS INT) + {shift})").alias("at")
        )
        sketches.add_days(
            sketches.daily_sketches(
                rows, F.col("at"), [], distinct=F.col("id"), value=F.col("id"), item=F.col("id") % 3
            ),
            path,
        )

    add(0, 4000)
    add(4000, 6000, 4)
    add(0, 4000)  # the same days again
    span = sketches.read_days(spark, path, date(2024, 1, 1), date(2024, 1, 5))
    assert "PartitionFilters: [isnotnull(day" in plan(span)
    (row,) = sketches.merged(span, [], [0.0, 0.5, 1.0], 5).collect()
    assert row.n_rows == 4500 and abs(row.n_distinct - 4500) < 4500 * 0.08
    assert row.quantiles[0] == 0 and row.quantiles[2] == 5996
    assert {top["item"] for top in row.top_items} == {0, 1, 2}
    assert sum(top["count"] for top in row.top_items) == 4500
    nothing = sketches.read_days(spark, path, date(2025, 1, 1), date(2025, 1, 5))
    assert sketches.merged(nothing, [], [0.5], 5).count() == 0


def test_sketches_leave_out_nulls(spark):
    rows = spark.range(10).select(F.when(F.col("id") < 4, F.col("id")).alias("x"))
    day = sketches.daily_sketches(
        rows, F.lit(date(2024, 1, 1)), [], distinct=F.col("x"), value=F.col("x"), item=F.col("x")
    )
    (row,) = sketches.merged(day, [], [1.0], 9).collect()
    assert row.n_rows == 10 and row.n_distinct == 4 and row.quantiles == [3.0]


@pytest.fixture(scope="module")
def related(spark):
    outer = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (1, "e")], "k long, name string")
    rows = [(1, i) for i in range(6)] + [(2, 9), (4, 1), (None, 5)]
    return outer, spark.createDataFrame(rows, "k long, v long")


def test_lateral_rows(related, rows_of):
    outer, inner = related
    found = top_related(outer, inner, ["k"], [F.desc("v")], 2)
    expected = [(1, n, v, r) for n in "ae" for v, r in ((5, 1), (4, 2))] + [(2, "b", 9, 1)]
    assert rows_of(found) == sorted(expected, key=str)
    left = top_related(outer, inner, ["k"], [F.desc("v")], 2, how="left")
    assert rows_of(left) == sorted([*expected, (3, "c", None, None), (None, "d", None, None)], key=str)
    assert top_related(outer.limit(0), inner, ["k"], [F.desc("v")], 2).count() == 0


def test_correlated_aggregates_and_existence(related, rows_of):
    outer, inner = related
    beside = beside_aggregates(outer, inner, ["k"], [F.sum("v").alias("total")])
    expected = [(1, "a", 15), (1, "e", 15), (2, "b", 9), (3, "c", None), (None, "d", None)]
    assert rows_of(beside) == sorted(expected, key=str)
    assert rows_of(having_related(outer, inner, ["k"])) == [(1, "a"), (1, "e"), (2, "b")]
    assert rows_of(having_related(outer, inner, ["k"], exists=False)) == [(3, "c"), (None, "d")]


def test_lateral_plan(spark, sf_dir):
    text = plan(REGISTERED["lateral_top_orders"].run(spark, sf_dir))
    assert "WindowGroupLimit" in text and "NestedLoop" not in text
    assert "EqualTo(c_mktsegment,BUILDING)" in text


LINKS = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 4), (5, 6), (2, 3), (6, None), (None, 1)]


def test_reachable_nodes_of_a_graph_with_cycles(spark, rows_of):
    links = spark.createDataFrame(LINKS, "source long, target long")
    roots = spark.createDataFrame([(1,), (1,), (None,)], "node long")
    assert rows_of(reachable(links, roots)) == [(1, 0), (2, 1), (3, 2), (4, 3)]
    assert rows_of(reachable(links, roots, 1)) == [(1, 0), (2, 1)]
    assert reachable(links, roots.limit(0)).count() == 0
    assert rows_of(reachable(links.limit(0), roots)) == [(1, 0)]


def test_reachable_nodes_of_a_random_graph(spark):
    dice = random.Random(42)
    pairs = [(dice.randrange(80), dice.randrange(80)) for _ in range(110)]
    depth, queue = {0: 0}, deque([0])
    while queue:
        node = queue.popleft()
        for source, target in pairs:
            if source == node and target not in depth:
                depth[target] = depth[node] + 1
                queue.append(target)
    links = spark.createDataFrame(pairs, "source long, target long")
    found = reachable(links, spark.createDataFrame([(0,)], "node long"))
    assert {row.node: row.depth for row in found.collect()} == depth


def test_links_are_made_once_however_many_rounds(spark):
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    pairs = spark.createDataFrame([(i, i + 1) for i in range(6)], "source long, target long")
    links = pairs.mapInPandas(make, "source long, target long")
    found = reachable(links, spark.createDataFrame([(0,)], "node long"))
    assert {row.node: row.depth for row in found.collect()} == {i: i for i in range(7)}
    assert made.value == 6


def test_walks_end_in_cycles(spark):
    links = spark.createDataFrame(LINKS, "source long, target long")
    roots = spark.createDataFrame([(1,), (5,)], "node long")
    found = {(row.root, tuple(row.path), row.is_cycle) for row in paths(links, roots, 9).collect()}
    assert found == {
        (1, (1,), False), (1, (1, 2), False), (1, (1, 2, 3), False), (1, (1, 2, 3, 1), True),
        (1, (1, 2, 3, 4), False), (1, (1, 2, 3, 4, 4), True), (5, (5,), False), (5, (5, 6), False),
    }
    assert paths(links, roots, 0).count() == 2

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tablework.operators import quantiles
from tablework.operators.quantiles import exact_percentiles
from tablework.workspace import new_path

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    got = {row["share"]: row["value"] for row in exact_percentiles(df, ["v"], SHARES).collect()}
    for share in SHARES:
        assert got[share] == pytest.approx(np.percentile(values, share * 100), rel=1e-12, abs=1e-12)


def test_spread_clustered_and_tied_values(spark):
    random = np.random.default_rng(1)
    check(spark, random.normal(size=4000))
    check(spark, np.concatenate([random.normal(size=500) * 1e-9 + 5, [1e15, -1e15]]))
    check(spark, np.concatenate([np.full(3000, 7.25), random.integers(0, 20, 500)]))
    check(spark, [3.5])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False).map(lambda v: round(v, 3)), min_size=1, max_size=60))
def test_any_values(spark, values):
    check(spark, values)


def test_missing_values_and_several_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, None), (None, 5.0, None), (4.0, float("nan"), None), (2.0, 7.0, None)],
        "a double, b double, c double",
    )
    got = {(r["column_name"], r["share"]): r["value"] for r in exact_percentiles(df, ["a", "b", "c"], [0.5]).collect()}
    assert got == {("a", 0.5): 2.0, ("b", 0.5): 6.0, ("c", 0.5): None}


def test_infinite_values_have_a_rank(spark):
    infinite = float("inf")

    def at(values, shares):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
        return [row["value"] for row in exact_percentiles(df, ["v"], shares).collect()]

    assert at([1.0, infinite, -infinite, 2.0], [0.0, 0.1, 0.5, 0.9, 1.0]) == [
        -infinite, -infinite, 1.5, infinite, infinite,
    ]
    assert at([infinite] * 3, [0.0, 0.3, 1.0]) == [infinite] * 3
    assert np.isnan(at([-infinite, infinite], [0.5])[0])
    crowd = [float(v) for v in range(200)] + [infinite, -infinite] * 50
    assert at(crowd, [0.1, 0.5, 0.9]) == [-infinite, np.percentile(crowd, 50), infinite]


def test_few_scans_whatever_the_distribution(spark):
    """The table is read three times, also for log-normal values; the rest is small."""
    folder = new_path(spark, "log-normal")
    draw = F.exp(F.randn(3) * 3)
    spark.range(200_000).select(draw.alias("v")).write.parquet(folder)
    df = spark.read.parquet(folder)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    watched = df.mapInArrow(count, df.schema)
    got = {row["share"]: row["value"] for row in exact_percentiles(watched, ["v"], SHARES).collect()}
    values = df.toPandas()["v"]
    for share in SHARES:
        assert got[share] == pytest.approx(np.percentile(values, share * 100), rel=1e-12)
    assert reads.value <= 4 * 200_000


def test_crowded_bounds_are_searched_in_spark(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW_VALUES", 10)
    random = np.random.default_rng(2)
    check(spark, np.round(random.normal(size=3000) * 50, 1))


def test_smallest_numbers(spark):
    check(spark, [0.0, 5e-324])

import pytest
from pyspark.sql import functions as F

from tablework.operators import combine


@pytest.fixture(scope="module")
def left(spark):
    """Two hot keys, one of them NULL, and many rare ones."""
    return spark.range(6000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 3 == 1, F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")))
        .otherwise(F.col("id") % 500)
        .cast("bigint")
        .alias("k"),
    )


@pytest.fixture(scope="module")
def right(spark):
    """Some keys twice, most once, many missing; one NULL."""
    rows = [(7, "seven"), (7, "again"), (None, "nothing")]
    rows += [(key, f"v{key}") for key in range(8, 4000, 3)]
    return spark.createDataFrame(rows, "k bigint, v string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_null_safe_join(left, right, rows_of, how):
    got = combine.keyed_join(left, right, "k", how, null_safe=True)
    other = right.withColumnRenamed("k", "rk")
    expected = left.join(other, F.col("k").eqNullSafe(F.col("rk")), how).select("id", "k", "v")
    assert rows_of(got.select("id", "k", "v")) == rows_of(expected)
    assert rows_of(got.filter("v = 'nothing'")) != []


def test_a_hot_key_is_split_and_nothing_runs_before_the_action(spark):
    """Half of the left rows have one key; the final plan reads its partition in pieces."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(0, 200_000, 1, 8).select(
            "id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k")
        )
        right = spark.range(0, 50_000, 1, 8).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        spark.sparkContext.setJobGroup("joining", "joining")
        joined = combine.keyed_join(left, right, "k")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("joining")
        assert len(joined.collect()) == 100_000 + 25_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)


def test_repeated_keys_on_the_right_do_not_repeat_rows(spark):
    left = spark.range(10).select((F.col("id") % 2).alias("k"))
    right = spark.range(1000).select(F.lit(1).cast("bigint").alias("k"))
    assert combine.keyed_join(left, right, "k", "left_semi").count() == 5
    assert combine.keyed_join(left, right, "k", "left_anti").count() == 5


def test_other_join_kinds_are_refused(left, right):
    with pytest.raises(ValueError):
        combine.keyed_join(left, right, "k", "full")


def test_union_refuses_swapped_columns(spark):
    first = spark.createDataFrame([("a", "b")], "x string, y string")
    with pytest.raises(ValueError):
        combine.union_checked(first, first.select("y", "x"))
    with pytest.raises(ValueError):
        combine.union_checked(first, spark.createDataFrame([("a", 1)], "x string, y int"))


def test_stacked_batches_keep_their_number(spark, rows_of):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    two = spark.createDataFrame([("b", 2)], "v string, k int")
    assert rows_of(combine.stack_batches([one, two])) == [(1, "a", 0), (2, "b", 1)]

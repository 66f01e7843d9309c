import pytest
from pyspark.sql import functions as F

from tablework.operators import aggregate, predicates, project, reshape, rows


@pytest.fixture(scope="module")
def copies(spark):
    """900 rows, a third of them copies of one."""
    text = F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), F.col("id") % 100))
    return spark.range(900).select("id", text.alias("text"), (F.col("id") * 2).alias("size"))


def test_first_of_each_group_of_copies(copies):
    firsts = rows.first_per_key(copies, ["text"], ["id"]).collect()
    assert len(firsts) == copies.select("text").distinct().count()
    assert {(r["id"], r["size"]) for r in firsts if r["text"] == "copy"} == {(0, 0)}


def test_later_copies_are_flagged(copies):
    flagged = rows.flag_duplicates(copies, ["text"], ["id"])
    assert flagged.count() == 900
    assert flagged.filter("text = 'copy' AND NOT is_duplicate").select("id").collect()[0][0] == 0
    assert flagged.filter(~F.col("is_duplicate")).count() == copies.select("text").distinct().count()


def test_copies_with_null_are_copies(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, text string")
    flags = rows.flag_duplicates(df, ["text"], ["id"]).orderBy("id").collect()
    assert [row["is_duplicate"] for row in flags] == [False, True, False]


def test_category_order(spark):
    df = spark.createDataFrame([("L", 1), ("S", 2), ("?", 3), ("M", 4), ("S", 5)], "size string, id int")
    ordered = rows.sort_by_category(df, "size", ["S", "M", "L"], ["id"]).collect()
    assert [row["id"] for row in ordered] == [2, 5, 4, 1, 3]


def test_null_goes_where_it_is_sent(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, v int")
    assert [r["id"] for r in df.orderBy(F.col("v").asc_nulls_last()).collect()] == [2, 3, 1]
    assert [r["id"] for r in df.orderBy("v").collect()] == [1, 2, 3]


def test_slices(spark):
    df = spark.range(20).repartition(3)
    assert [r[0] for r in predicates.position_slice(df, ["id"], 5, 8).collect()] == [5, 6, 7]
    assert [r[0] for r in rows.last_rows(df, ["id"], 3).collect()] == [19, 18, 17]
    assert predicates.label_slice(df, "id", 5, 8).count() == 4
    with pytest.raises(ValueError):
        predicates.position_slice(df, ["id"], 4, 2)


def test_key_sample_is_stable_and_nested(spark):
    df = spark.range(10_000)
    small, large = (rows.sample_by_key(df, "id", share) for share in (0.1, 0.3))
    assert 850 < small.count() < 1150
    assert small.exceptAll(large).count() == 0
    assert rows.sample_by_key(df, "id", 0.0).count() == 0


def test_parameters_are_values_not_sql(spark):
    df = spark.createDataFrame([("x' OR 'a'='a", 1), ("b", 2)], "name string, n int")
    found = predicates.filter_with(df, "name = :name", {"name": "x' OR 'a'='a"})
    assert [row["n"] for row in found.collect()] == [1]


def test_renaming_is_checked(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert project.rename_columns(df, {"a": "b", "b": "a"}).columns == ["b", "a"]
    with pytest.raises(ValueError):
        project.rename_columns(df, {"a": "b"})
    with pytest.raises(ValueError):
        project.rename_columns(df, {"missing": "c"})
    with pytest.raises(ValueError):
        project.select_except(df, ["missing"])


def test_means_replace_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 3.0), (None, 8.0), (None, None), ("b", None)], "g string, v double"
    )
    assert sorted(r["v"] for r in aggregate.impute_mean(df, "v").collect()) == [1.0, 3.0, 4.0, 4.0, 4.0, 8.0]
    grouped = aggregate.impute_group_mean(df, "v", "g").collect()
    assert sorted(str(r["v"]) for r in grouped) == ["1.0", "2.0", "3.0", "8.0", "8.0", "None"]


def test_shape_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert tuple(aggregate.shape(empty).first()) == (0, 2, True)


def test_stack_then_unstack_is_the_input(spark, rows_of):
    df = spark.createDataFrame([(1, 5, None), (2, 6, 7)], "k int, x int, y int")
    long = reshape.stack(df, ["k"], ["x", "y"], "name", "value")
    assert long.count() == 3
    assert rows_of(reshape.unstack(long, ["k"], ["x", "y"], "name", "value")) == rows_of(df)

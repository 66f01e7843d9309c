from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablework.sources.files import file_sizes
from tablework.versions import changes as v
from tablework.workspace import new_path

KEY = ["id"]
AT = datetime(2024, 5, 1)


@pytest.fixture(scope="module")
def path(spark):
    """1 inserts 0..99; 2 deletes 0..9; 3 changes 5..29 (some come back); 4 deletes 90..99."""
    path = new_path(spark, "versions")
    base = spark.range(100).select("id", F.lit("a").alias("s"), F.col("id").cast("double").alias("v"))
    v.write_version(base, path, 1, "I", AT, KEY)
    v.write_version(base.filter("id < 10"), path, 2, "D", AT, KEY)
    changed = base.filter("id BETWEEN 5 AND 29").withColumns(
        {"s": F.lit(None).cast("string"), "v": F.col("v") + 0.5}
    )
    v.write_version(changed, path, 3, "U", AT, KEY)
    v.write_version(base.filter("id >= 90"), path, 4, "D", AT, KEY)
    return path


@pytest.fixture(scope="module")
def changes(spark, path):
    return v.read_changes(spark, path)


def test_snapshots(changes):
    assert [v.snapshot(changes, KEY, as_of).count() for as_of in (1, 2, 3, 4)] == [100, 90, 95, 85]
    back = v.snapshot(changes, KEY, 3).filter("id = 7").first()
    assert (back["s"], back["v"]) == (None, 7.5)
    assert v.latest_version(changes) == 4


@pytest.mark.parametrize("version", [1, 2, 3, 4])
def test_restoring_gives_the_version_back(spark, changes, rows_of, version):
    fixes = v.restoration(changes, KEY, version)
    path = new_path(spark, "restored")
    for number in range(1, 5):
        rows = changes.filter(F.col(v.VERSION) == number).drop(v.VERSION, v.AT)
        v.write_version(rows, path, number, None, AT, KEY)
    v.write_version(fixes, path, 5, None, AT, KEY)
    now = v.snapshot(v.read_changes(spark, path), KEY)
    assert rows_of(now) == rows_of(v.snapshot(changes, KEY, version))
    assert fixes.count() == {1: 40, 2: 35, 3: 10, 4: 0}[version]


def test_retention_keeps_later_versions(spark, changes, rows_of):
    path = new_path(spark, "retained")
    v.write_retained(changes, KEY, 2, path)
    kept = v.read_changes(spark, path)
    assert kept.count() == changes.count() - 20
    for version in (2, 3, 4):
        assert rows_of(v.snapshot(kept, KEY, version)) == rows_of(v.snapshot(changes, KEY, version))


def test_history_counts_changes(changes):
    got = {(r[v.VERSION], r[v.OP]): r["n_rows"] for r in v.history(changes).collect()}
    assert got == {(1, "I"): 100, (2, "D"): 10, (3, "U"): 25, (4, "D"): 10}


def test_a_version_is_written_once(spark, path):
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        v.write_version(spark.range(1), path, 4, "I", AT, KEY)


def test_unfinished_versions_are_not_read(spark, path, changes, rows_of):
    started = f"{path}/{v.VERSION}=5/part-00000.parquet".removeprefix("file:")
    source = changes.filter("id < 3").drop(v.VERSION).coalesce(1)
    staged = new_path(spark, "staged")
    source.write.parquet(staged)
    file = next(Path(staged.removeprefix("file:")).glob("part-*.parquet"))
    Path(started).parent.mkdir()
    Path(started).write_bytes(file.read_bytes())
    assert v.complete_versions(spark, path) == [1, 2, 3, 4]
    assert v.next_version(spark, path) == 6
    assert rows_of(v.read_changes(spark, path)) == rows_of(changes)


def test_two_rows_with_one_key_are_refused(spark):
    path = new_path(spark, "twice")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id long, s string")
    with pytest.raises(ValueError, match="2 times"):
        v.write_version(twice, path, 1, "I", AT, KEY)
    assert v.complete_versions(spark, path) == []


def test_upserts_tell_new_from_changed(spark, changes):
    rows = spark.createDataFrame([(50, "x", 1.0), (95, "x", 1.0), (500, "x", 1.0)], "id long, s string, v double")
    ops = {row["id"]: row[v.OP] for row in v.upserting(changes, rows, KEY).collect()}
    assert ops == {50: "U", 95: "I", 500: "I"}


def test_compacting_keeps_rows_in_fewer_files(spark, changes, rows_of):
    path = new_path(spark, "compacted")
    live = v.snapshot(changes, KEY)
    v.compact(live, path, rows_per_file=50)
    assert file_sizes(spark, path, ".parquet").count() == 2
    assert rows_of(spark.read.parquet(path)) == rows_of(live)


def files_that_may_hold(spark, path, column, value):
    ranges = spark.read.parquet(path).groupBy(F.input_file_name()).agg(
        F.min(column).alias("low"), F.max(column).alias("high")
    )
    return ranges.filter(F.lit(value).between(F.col("low"), F.col("high"))).count()


def test_clustering_narrows_both_columns(spark, rows_of):
    path = new_path(spark, "clustered")
    df = spark.range(16_000).select(
        "id", (F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b")
    )
    v.cluster(df, path, ["a", "b"], ["id"], rows_per_file=1000)
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    files = file_sizes(spark, path, ".parquet").count()
    assert files == 16
    assert files_that_may_hold(spark, path, "a", 300) <= 8
    assert files_that_may_hold(spark, path, "b", 300) <= 8


def test_a_crowded_place_is_cut_into_several_files(spark):
    path = new_path(spark, "crowded")
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("a"))
    v.cluster(df, path, ["a"], ["id"], rows_per_file=1000)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] < 2000


def test_schema_check(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    assert v.check_schema(df.select("s", "id"), df.schema).columns == ["id", "s"]
    for wrong in (df.drop("s"), df.withColumn("x", F.lit(1)), df.withColumn("id", F.lit("1"))):
        with pytest.raises(ValueError):
            v.check_schema(wrong, df.schema)


def test_rows_of_a_version_are_computed_once(spark):
    path, seen = new_path(spark, "once"), spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(100).mapInPandas(counting, "id long")
    v.write_version(rows, path, 1, "I", AT, KEY)
    assert seen.value == 100
    assert v.complete_versions(spark, path) == [1]


def test_a_refused_version_leaves_its_number_free(spark, rows_of):
    path = new_path(spark, "again")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id long, s string")
    with pytest.raises(ValueError, match="2 times"):
        v.write_version(twice, path, 1, "I", AT, KEY)
    assert v.next_version(spark, path) == 1
    v.write_version(twice.limit(1), path, 1, "I", AT, KEY)
    assert v.read_changes(spark, path).count() == 1


def test_a_version_without_rows_is_complete(spark):
    path = new_path(spark, "none")
    v.write_version(spark.range(0), path, 1, "I", AT, KEY)
    assert v.complete_versions(spark, path) == [1]
    assert v.read_changes(spark, path).count() == 0

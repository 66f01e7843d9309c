"""Several writers on one table, conditional merges, and records that are put once."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablework.versions import commits as c
from tablework.versions.changes import OP, snapshot
from tablework.workspace import new_path

AT = datetime(2024, 1, 1)
KEY = ["k"]


def rows(spark, values, op="I"):
    return spark.createDataFrame([(*value, op) for value in values], f"k long, v long, {OP} string")


def live(spark, path):
    return {row.k: row.v for row in snapshot(c.committed_changes(spark, path), KEY).collect()}


def test_a_record_is_put_once(spark):
    path = new_path(spark, "records") + "/1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: c.put_if_absent(spark, path, f"text {i}"), range(16)))
    assert sum(won) == 1
    assert [row.value for row in spark.read.text(path).collect()] == [f"text {won.index(True)}"]


def test_a_record_is_put_once_by_rename(spark):
    """Through a storage that only Hadoop's interface reaches."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = new_path(spark, "mounted").removeprefix("file:")
    conf.set("fs.viewfs.mounttable.records.link./here", f"file://{folder}")
    spark.range(1).write.parquet(f"file://{folder}/made")
    path = "viewfs://records/here/log/1.json"
    assert [c.put_if_absent(spark, path, text) for text in ("one", "two")] == [True, False]
    assert [row.value for row in spark.read.text(path).collect()] == ["one"]


def test_writers_of_other_keys_all_commit(spark):
    path = new_path(spark, "table")

    def write(writer):
        for i in range(3):
            c.transact(spark, path, KEY, lambda _: rows(spark, [(10 * writer + i, writer)]), "insert", AT)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    assert [record.version for record in c.records(spark, path)] == list(range(1, 10))
    assert live(spark, path) == {10 * writer + i: writer for writer in range(3) for i in range(3)}


def test_writers_of_the_same_key_lose_nothing(spark):
    path = new_path(spark, "table")
    c.transact(spark, path, KEY, lambda _: rows(spark, [(1, 0), (2, 0)]), "insert", AT)
    built = []

    def add(writer):
        def build(changes):
            built.append(writer)
            return snapshot(changes, KEY).where("k = 1").withColumns({"v": F.col("v") + 1, OP: F.lit("U")})

        for _ in range(2):
            c.transact(spark, path, KEY, build, f"add {writer}", AT)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(add, range(2)))
    assert live(spark, path) == {1: 4, 2: 0}
    assert len(c.records(spark, path)) == 5 and len(built) >= 4


@pytest.mark.parametrize("serializable", [False, True])
def test_what_counts_as_a_conflict(spark, serializable):
    """Another writer commits while this one builds: another key, then the same one."""
    path = new_path(spark, "table")
    c.transact(spark, path, KEY, lambda _: rows(spark, [(1, 0), (2, 0)]), "insert", AT)
    seen = []

    def build(changes):
        seen.append(snapshot(changes, KEY).count())
        if len(seen) < 3:
            key = 2 if len(seen) == 1 else 1
            if serializable or len(seen) == 1:
                c.transact(spark, path, KEY, lambda _: rows(spark, [(key + 10, 5)]), "other", AT)
        return rows(spark, [(1, 7)], "U")

    version = c.transact(spark, path, KEY, build, "update", AT, serializable=serializable)
    assert seen == ([2, 3, 4] if serializable else [2])
    assert version == (4 if serializable else 3)
    assert live(spark, path)[1] == 7
    assert snapshot(c.committed_changes(spark, path, as_of=1), KEY).count() == 2


def test_too_many_conflicts_and_repeated_keys(spark):
    path = new_path(spark, "table")
    with pytest.raises(ValueError, match="no committed"):
        c.committed_changes(spark, path)
    c.transact(spark, path, KEY, lambda _: rows(spark, [(1, 0)]), "insert", AT)

    def build(changes):
        c.transact(spark, path, KEY, lambda _: rows(spark, [(1, 3)], "U"), "other", AT)
        return rows(spark, [(1, 7)], "U")

    with pytest.raises(c.ConflictError, match="2 attempts"):
        c.transact(spark, path, KEY, build, "update", AT, attempts=2)
    with pytest.raises(ValueError, match="2 times"):
        c.transact(spark, path, KEY, lambda _: rows(spark, [(5, 1), (5, 2)]), "insert", AT)
    assert live(spark, path) == {1: 3}


def test_merge_takes_the_first_clause_that_fits(spark, rows_of):
    target = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (None, 0)], "k long, v long")
    source = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (8, 80, "c"), (9, 90, "d"), (None, 1, "e")], "k long, w long, n string")
    merged = c.merge_changes(
        target, source, KEY,
        matched=[c.Delete(F.col("source.n") == "b"), c.Update({"v": F.col("source.w") + F.col("target.v")})],
        not_matched=[c.Insert({"v": F.col("source.w")}, F.col("source.k") > 8), c.Insert({}, F.col("source.k") > 0)],
        not_matched_by_source=[c.Update({"v": F.lit(0)}, F.col("target.k") == 3)],
    )
    assert merged.columns == ["k", "v", OP]
    assert rows_of(merged) == [(1, 11, "U"), (2, 2, "D"), (3, 0, "U"), (8, None, "I"), (9, 90, "I")]
    only = c.merge_changes(target, source, KEY, matched=[c.Delete()])
    assert rows_of(only) == [(1, 1, "D"), (2, 2, "D")]
    assert "FullOuter" not in only._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(TypeError, match="Insert"):
        c.merge_changes(target, source, KEY, matched=[c.Insert()])
    with pytest.raises(ValueError, match="no such columns"):
        c.merge_changes(target, source, KEY, matched=[c.Update({"x": F.lit(1)})])


def test_changes_of_a_version_stay_in_their_tasks(spark):
    """A shuffle by the folder would bring all rows of a version to one task."""
    path = new_path(spark, "table")
    for number in range(2):
        c.transact(spark, path, KEY, lambda _: rows(spark, [(2 * number, 1), (2 * number + 1, 1)]), "insert", AT)
    changes = c.committed_changes(spark, path)
    text = changes._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    found = {(row.k, row[c.VERSION]) for row in changes.collect()}
    assert found == {(0, 1), (1, 1), (2, 2), (3, 2)}

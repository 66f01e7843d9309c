from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablework.streaming import incremental
from tablework.versions import changes as v
from tablework.workspace import new_path


@pytest.fixture
def folders(spark):
    return {name: new_path(spark, name) for name in ("landing", "sink", "progress", "schema")}


def load(spark, folders, schema):
    stream = incremental.new_files(spark, folders["landing"], schema)
    incremental.append_available(stream, folders["sink"], folders["progress"])
    return spark.read.parquet(folders["sink"]).count()


def test_each_file_is_loaded_once(spark, folders):
    batch = spark.range(10)
    counts = []
    for rows in (batch, None, batch, batch):
        if rows is not None:
            rows.write.mode("append").parquet(folders["landing"])
        counts.append(load(spark, folders, batch.schema))
    assert counts == [10, 10, 20, 30]


def test_drift_is_refused(spark, folders):
    spark.range(3).write.parquet(folders["landing"])
    incremental.save_schema(spark, spark.range(1).schema, folders["schema"])
    schema = incremental.load_schema(spark, folders["schema"])
    incremental.refuse_drift(spark, folders["landing"], schema)
    spark.range(3).withColumn("new", F.lit(1)).write.mode("append").parquet(folders["landing"])
    with pytest.raises(ValueError, match="new"):
        incremental.refuse_drift(spark, folders["landing"], schema)


def test_streams_never_overwrite_what_others_wrote(spark, folders):
    """A table with a version, a stream, the same batch again, and a stream from the beginning."""
    at, key = datetime(2024, 1, 1), ["id"]
    rows = spark.range(20).withColumn("v", F.col("id") * 2)
    older = spark.range(100, 105).withColumn("v", F.col("id"))
    v.write_version(older, folders["sink"], 1, "I", at, key)
    rows.write.parquet(folders["landing"])

    def run(progress):
        stream = incremental.new_files(spark, folders["landing"], rows.schema)
        incremental.append_versions(stream, folders["sink"], f"{folders['progress']}-{progress}", at, key)
        return v.complete_versions(spark, folders["sink"])

    assert run("first") == [1, 2]
    assert run("first") == [1, 2]
    commits = Path(f"{folders['progress']}-first".removeprefix("file:")) / "commits"
    for commit in [*commits.glob("0"), *commits.glob(".0.crc")]:
        commit.rename(commit.with_name(f"lost-{commit.name}"))  # the batch must run again
    assert run("first") == [1, 2]
    assert run("second") == [1, 2, 3]
    changes = v.read_changes(spark, folders["sink"])
    assert changes.count() == 5 + 20 + 20
    assert v.snapshot(changes, key).exceptAll(rows.unionByName(older)).count() == 0

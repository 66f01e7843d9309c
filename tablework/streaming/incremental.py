"""Loading each new file of a folder exactly once."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablework.versions.changes import next_version, write_version

MAX_FILES = 1000


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """Store the schema of a stream beside it, once."""
    spark.createDataFrame([(schema.json(),)], "value string").write.text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(path).first()["value"]))


def refuse_drift(
    spark: SparkSession, folder: str, schema: StructType, modified_after: str | None = None
) -> None:
    """Raise if the files of ``folder`` together have other columns than ``schema``.

    A stream would silently drop a new column. Footers are read in parallel;
    ``modified_after`` (a UTC time) leaves out files that earlier runs have checked.
    """
    reader = spark.read.option("mergeSchema", "true")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
        try:
            found = {field.name: field.dataType for field in reader.parquet(folder).schema}
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return  # nothing new
    else:
        found = {field.name: field.dataType for field in reader.parquet(folder).schema}
    expected = {field.name: field.dataType for field in schema}
    if found != expected:
        names = sorted(set(found.items()) ^ set(expected.items()), key=str)
        raise ValueError(f"files and stored schema differ in {names}")


def new_files(
    spark: SparkSession, folder: str, schema: StructType, max_files: int = MAX_FILES
) -> DataFrame:
    """A stream of the Parquet files in ``folder``: those that are there, then each new one.

    A batch takes at most ``max_files`` files, so a large backlog becomes several batches.
    """
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)
    )


def start_append(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append to Parquet files; with ``every`` keep polling, without it stop when caught up."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all files not loaded before and return."""
    start_append(stream, path, checkpoint).awaitTermination()


def append_versions(
    stream: DataFrame, path: str, checkpoint: str, at: datetime, key: Sequence[str]
) -> None:
    """Store each batch of new files as one more version of a change table and return.

    The table may hold versions of others, which stay. The number a batch has taken is noted
    beside the versions under the stream's checkpoint and the batch's number, so that a batch
    that runs again after a failure replaces what it wrote itself and nothing else.
    """
    spark = stream.sparkSession
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:32]

    def store(batch: DataFrame, number: int) -> None:
        note = f"{path}/_batches/{name}-{number}"
        try:
            version = int(spark.read.text(note).first()["value"])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            version = next_version(spark, path)
            spark.createDataFrame([(str(version),)], "value string").coalesce(1).write.text(note)
        write_version(batch, path, version, "I", at, key, mode="overwrite")

    (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )

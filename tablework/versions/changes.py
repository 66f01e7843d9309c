"""Versioned tables as plain Parquet folders of changes.

A table is a folder with one sub-folder per version; each row there is a change of one key:
``_op`` is I (insert), U (update) or D (delete), ``_at`` the time of the version. Snapshots,
restores and retention are aggregations over the changes: one pass, combined before the
shuffle, without a join. There is one writer; a key occurs once per version, which writing
checks; all columns can be ordered (no maps). A version counts once its folder holds the mark of
a finished write.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablework.sinks.files import write_partitioned, write_sized

VERSION, OP, AT = "_version", "_op", "_at"
CONTROL = (VERSION, OP, AT)

#: Whether Spark marks a folder as finished once all tasks are through.
MARKING = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def write_version(
    rows: DataFrame,
    path: str,
    version: int,
    op: str | None,
    at: datetime,
    key: Sequence[str],
    mode: str = "error",
) -> None:
    """Store ``rows`` as a version; with ``op=None`` they already carry their own.

    Refused if two rows have the same key, as a reader could keep only one of them. The rows are
    computed once: they are written without the mark of a finished write, the keys are counted
    in the written files, and then the version gets its mark or is taken away again.
    """
    spark, folder = rows.sparkSession, f"{path}/{VERSION}={version}"
    if op is not None:
        rows = rows.withColumn(OP, F.lit(op))
    stamped = rows.withColumn(AT, F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
    stamped.write.mode(mode).option(MARKING, "false").parquet(folder)
    written = spark.read.schema(stamped.schema).parquet(folder)
    repeated = written.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    storage, at_folder = _storage(spark, folder)
    if repeated is not None:
        storage.delete(at_folder, True)
        raise ValueError(f"version {version} holds a key {repeated['n']} times: {repeated}")
    storage.create(_storage(spark, f"{folder}/_SUCCESS")[1], True).close()


def _storage(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit the pattern, in any storage Spark knows."""
    storage, glob = _storage(spark, pattern)
    return [str(found.getPath()) for found in storage.globStatus(glob) or []]


def _numbers(paths: list[str]) -> list[int]:
    return sorted(int(re.search(rf"{VERSION}=(\d+)", path).group(1)) for path in paths)


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose write has finished: their own, or that of the whole folder at once."""
    whole = _paths(spark, f"{path}/_SUCCESS")
    return _numbers(_paths(spark, f"{path}/{VERSION}=*" + ("" if whole else "/_SUCCESS")))


def next_version(spark: SparkSession, path: str) -> int:
    """A number no version has, finished or not."""
    return max(_numbers(_paths(spark, f"{path}/{VERSION}=*")), default=0) + 1


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes of finished versions, ``_version`` from the folder names (filters prune)."""
    versions = complete_versions(spark, path)
    if not versions:
        raise ValueError(f"no finished version in {path}")
    folders = [f"{path}/{VERSION}={version}" for version in versions]
    return spark.read.option("basePath", path).parquet(*folders)


def latest_version(changes: DataFrame) -> int:
    """The highest version; reads folder names and footers, no column data."""
    return changes.agg(F.max(VERSION)).first()[0]


def upserting(changes: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` with ``_op``: U where the key is live, I where it is new."""
    live = snapshot(changes, key).select(*key, F.lit("U").alias(OP))
    return rows.join(live, list(key), "left").withColumn(OP, F.coalesce(OP, F.lit("I")))


def _payload(changes: DataFrame, key: Sequence[str]) -> list[str]:
    return [name for name in changes.columns if name not in {*key, *CONTROL}]


def snapshot(changes: DataFrame, key: Sequence[str], as_of: int | None = None) -> DataFrame:
    """The rows of the table now, or as of a version."""
    if as_of is not None:
        changes = changes.filter(F.col(VERSION) <= as_of)
    payload = _payload(changes, key)
    last = changes.groupBy(*key).agg(F.max(F.struct(VERSION, OP, *payload)).alias("_last"))
    live = last.filter(F.col(f"_last.{OP}") != "D")
    return live.select(*key, *[F.col(f"_last.{name}").alias(name) for name in payload])


def deletion(changes: DataFrame, key: Sequence[str], condition: Column | str) -> DataFrame:
    """The current rows that fulfil ``condition``, to be stored as a D version."""
    return snapshot(changes, key).filter(condition)


def restoration(changes: DataFrame, key: Sequence[str], version: int) -> DataFrame:
    """The changes, with ``_op``, that turn the current rows into those of ``version``.

    Only rows that differ are returned, so restoring costs as much storage as it undoes.
    """
    payload = _payload(changes, key)
    row = F.struct(VERSION, OP, *payload)
    both = changes.groupBy(*key).agg(
        F.max(row).alias("_now"),
        F.max(F.when(F.col(VERSION) <= version, row)).alias("_then"),
    )
    was_live = F.col("_then").isNotNull() & (F.col(f"_then.{OP}") != "D")
    is_live = F.col(f"_now.{OP}") != "D"
    same = F.lit(True)
    for name in payload:
        same = same & F.col(f"_now.{name}").eqNullSafe(F.col(f"_then.{name}"))
    op = F.when(was_live & ~(is_live & same), "U").when(~was_live & is_live, "D")
    values = [
        F.when(F.col(OP) == "U", F.col(f"_then.{name}")).otherwise(F.col(f"_now.{name}")).alias(name)
        for name in payload
    ]
    return both.withColumn(OP, op).filter(F.col(OP).isNotNull()).select(*key, *values, OP)


def history(changes: DataFrame) -> DataFrame:
    """Rows changed per version and kind of change, with the version's time."""
    return changes.groupBy(VERSION, OP).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(AT).alias("committed_at")
    )


def retained(changes: DataFrame, key: Sequence[str], horizon: int) -> DataFrame:
    """The changes needed to read version ``horizon`` and every later one.

    Keeps the last change of each key up to the horizon, unless it is a deletion, and all
    later changes.
    """
    payload = _payload(changes, key)
    kept = (
        changes.filter(F.col(VERSION) <= horizon)
        .groupBy(*key)
        .agg(F.max(F.struct(*CONTROL, *payload)).alias("_last"))
        .filter(F.col(f"_last.{OP}") != "D")
        .select(*key, "_last.*")
    )
    return kept.unionByName(changes.filter(F.col(VERSION) > horizon))


def write_retained(changes: DataFrame, key: Sequence[str], horizon: int, path: str) -> None:
    """Write the retained changes as a table of their own; the old folder stays untouched."""
    write_partitioned(retained(changes, key, horizon), path, [VERSION])


def compact(rows: DataFrame, path: str, rows_per_file: int) -> None:
    """Rewrite rows into few files of even size."""
    write_sized(rows, path, rows_per_file)


def curve_position(df: DataFrame, columns: Sequence[str], bits: int = 8) -> tuple[DataFrame, Column]:
    """``df`` with helper columns, and each row's place on a Z-shaped curve through ``columns``.

    Each column is cut at its quantiles into ``2 ** bits`` steps, so that a crowded value range
    gets as many steps as its rows deserve; the bits of the step numbers are interleaved.
    """
    steps = 2**bits
    if (bits + 1) * len(columns) > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit into one number")
    shares = [number / steps for number in range(1, steps)]
    numeric = df.withColumns({f"_c_{name}": F.col(name).cast("double") for name in columns})
    cuts = numeric.approxQuantile([f"_c_{name}" for name in columns], shares, 1 / (4 * steps))
    for name, at in zip(columns, cuts):
        bucketizer = Bucketizer(
            splits=[-math.inf, *sorted(set(at)), math.inf],
            inputCol=f"_c_{name}",
            outputCol=f"_s_{name}",
            handleInvalid="keep",
        )
        numeric = bucketizer.transform(numeric)
    position = F.lit(0).cast("bigint")
    for bit in range(bits + 1):  # one more: NULL has a step of its own behind the others
        for number, name in enumerate(columns):
            step = F.coalesce(F.col(f"_s_{name}"), F.lit(steps)).cast("bigint")
            one = F.shiftright(step, bit).bitwiseAND(F.lit(1))
            position = position.bitwiseOR(F.shiftleft(one, bit * len(columns) + number))
    return numeric, position


def cluster(
    df: DataFrame, path: str, columns: Sequence[str], key: Sequence[str], rows_per_file: int
) -> None:
    """Rewrite rows so that each file covers a small range of every one of ``columns``.

    ``key`` is unique and lets Spark cut a hot place on the curve into several files. Passes
    over ``df`` several times, so it should be a scan or the result of ``checkpointed``.
    """
    files = max(math.ceil(df.count() / rows_per_file), 1)
    placed, position = curve_position(df, columns)
    placed = placed.withColumn("_z", position)
    ordered = placed.repartitionByRange(files, "_z", *key).sortWithinPartitions("_z", *key)
    ordered.select(df.columns).write.parquet(path)


def check_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """``df`` with its columns in declared order; an error if names or types differ."""

    def columns(schema: StructType) -> dict[str, str]:
        return {field.name: field.dataType.simpleString() for field in schema}

    if columns(df.schema) != columns(declared):
        raise ValueError(f"declared {columns(declared)}, got {columns(df.schema)}")
    return df.select(declared.names)

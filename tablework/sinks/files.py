"""File writers."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.sources.files import CSV_OPTIONS, TEXT_OPTIONS


def write_csv(df: DataFrame, path: str, mode: str = "error", **options: str) -> None:
    df.write.mode(mode).options(**(CSV_OPTIONS | options)).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "error", **options: str) -> None:
    df.write.mode(mode).options(**(TEXT_OPTIONS | options)).json(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 20_000) -> None:
    """JSON arrays over many lines, one array per file and about ``rows_per_file`` rows in each."""
    files = max(math.ceil(df.count() / rows_per_file), 1)

    def bracketed(batches):
        started = False
        for batch in batches:
            lines = ", " + batch["value"]
            if len(lines) and not started:
                lines.iloc[0] = "[ " + batch["value"].iloc[0]
                started = True
            yield pd.DataFrame({"value": lines})
        if started:
            yield pd.DataFrame({"value": ["]"]})

    objects = df.select(F.to_json(F.struct("*"), dict(TEXT_OPTIONS)).alias("value"))
    objects.repartition(files).mapInPandas(bracketed, "value string").write.text(path)


def write_lines(df: DataFrame, path: str, separator: str = ",") -> None:
    """One text line per row; a NULL field is an empty one, so that all others keep their place."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    df.select(F.concat_ws(separator, *fields).alias("value")).write.text(path)


def write_files(df: DataFrame, path: str, files: int) -> None:
    """Parquet in exactly ``files`` files of about equal size (fewer if there are fewer rows)."""
    df.repartition(files).write.parquet(path)


def write_sized(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Parquet in few files of even size, none with more than ``rows_per_file`` rows.

    The rebalance hint merges small and splits large partitions by their measured bytes.
    """
    balanced = df.hint("rebalance")
    balanced.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "error") -> None:
    """Parquet in one folder per value of ``columns``.

    Rows are brought together per folder first, so that not every task writes a file into
    every folder. The rebalance hint lets Spark split a folder that holds much of the data
    into several tasks and files.
    """
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)

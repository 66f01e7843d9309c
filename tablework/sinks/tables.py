"""Catalog databases and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_database(spark: SparkSession, name: str, path: str) -> None:
    """A database whose managed tables lie below ``path``, a folder all executors reach."""
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")


def create_managed(df: DataFrame, table: str) -> None:
    """A table that owns its files: dropping it deletes them."""
    df.write.format("parquet").saveAsTable(table)


def create_external(spark: SparkSession, table: str, schema: StructType, path: str) -> None:
    """A table over a folder: dropping it leaves the files."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")


def append(df: DataFrame, table: str) -> None:
    """Add rows, matched by name; refuses missing and extra columns."""
    target = df.sparkSession.table(table).columns
    if sorted(target) != sorted(df.columns):
        raise ValueError(f"{table} has columns {target}, the rows have {df.columns}")
    df.select(target).write.insertInto(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE {table}")

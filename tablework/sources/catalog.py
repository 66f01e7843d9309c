"""Tables of the session catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """One row per table of a database: ``table_name``, ``table_type``."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, table_type string")


def table_sizes(spark: SparkSession, database: str) -> DataFrame:
    """The listed tables with their row counts, one aggregate per table in one job."""
    listed = list_tables(spark, database)
    counts = [
        spark.table(f"{database}.{t.name}")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("table_name", F.lit(t.name))
        for t in spark.catalog.listTables(database)
    ]
    if not counts:
        return listed.withColumn("n_rows", F.lit(None).cast("bigint"))
    return listed.join(reduce(DataFrame.unionByName, counts), "table_name")

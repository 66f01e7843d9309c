"""Queries that write files and tables and read them back."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.plans.embedded import database_url, key_slices
from tablework.plans.registry import query, table
from tablework.sinks import files, tables
from tablework.sinks.databases import write_table
from tablework.sources.databases import read_range
from tablework.sources.files import file_sizes, read_csv, read_json
from tablework.workspace import new_name, new_path


@query("k1_write_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def write_csv(spark, sf_dir):
    """Whole texts with quotes and line breaks."""
    documents = table(spark, sf_dir, "documents")
    path = new_path(spark, "documents-csv")
    # Records over several lines are read one file per task, so the files are bounded.
    files.write_csv(documents, path, maxRecordsPerFile="20000")
    return read_csv(spark, path, documents.schema, multiLine="true")


@query("k2_write_json", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def write_json(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    path = new_path(spark, "documents-json")
    files.write_json(documents, path)
    return read_json(spark, path, documents.schema)


@query("k3_write_parquet", "SELECT page_id, url, html FROM pages")
def write_parquet(spark, sf_dir):
    path = new_path(spark, "pages-parquet")
    table(spark, sf_dir, "pages").write.parquet(path)
    return spark.read.parquet(path)


@query("k4_write_orc", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def write_orc(spark, sf_dir):
    path = new_path(spark, "events-orc")
    table(spark, sf_dir, "events").write.orc(path)
    return spark.read.orc(path)


@query(
    "k5_write_text",
    "SELECT p_partkey || '|' || p_name || '|' || p_brand || '|' || p_size AS value FROM part",
)
def write_text(spark, sf_dir):
    path = new_path(spark, "part-text")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    files.write_lines(parts, path, "|")
    return spark.read.text(path)


@query(
    "k6_mode_error",
    """
    SELECT 'first' AS attempt, 'written' AS outcome, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'second', 'PATH_ALREADY_EXISTS', count(*) FROM orders
    """,
)
def mode_error(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = new_path(spark, "orders-once")
    results = []
    for attempt in ("first", "second"):
        try:
            orders.write.mode("error").parquet(path)
            outcome = "written"
        except AnalysisException as error:
            outcome = error.getCondition()
        results.append((attempt, outcome, spark.read.parquet(path).count()))
    return spark.createDataFrame(results, "attempt string, outcome string, n_rows bigint")


@query("k7_mode_ignore", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def mode_ignore(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = new_path(spark, "orders-first")
    orders.filter("o_orderstatus = 'F'").write.mode("ignore").parquet(path)
    orders.write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


@query("k8_mode_overwrite", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def mode_overwrite(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = new_path(spark, "orders-last")
    orders.write.mode("overwrite").parquet(path)
    orders.filter("o_orderstatus = 'O'").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query(
    "k9_mode_append",
    "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders",
)
def mode_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    path = new_path(spark, "orders-twice")
    for _ in range(2):
        files.write_csv(orders, path, mode="append")
    return read_csv(spark, path, orders.schema)


@query(
    "k10_compression",
    """
    SELECT codec, count(*) AS n_rows, true AS smaller_than_plain
    FROM orders CROSS JOIN (VALUES ('gzip'), ('snappy'), ('zstd')) c(codec) GROUP BY codec
    """,
)
def compression(spark, sf_dir):
    """Rows per codec, and whether its files are smaller than the uncompressed ones."""
    orders = table(spark, sf_dir, "orders")

    def written(codec: str) -> tuple[DataFrame, DataFrame]:
        path = new_path(spark, f"orders-{codec}")
        orders.write.option("compression", codec).parquet(path)
        return spark.read.parquet(path), file_sizes(spark, path, ".parquet")

    plain = written("none")[1].agg(F.sum("length")).first()[0]
    results = []
    for codec in ("gzip", "snappy", "zstd"):
        rows, sizes = written(codec)
        smaller = sizes.agg(F.sum("length") < plain).scalar()
        results.append(
            rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumns(
                {"codec": F.lit(codec), "smaller_than_plain": smaller}
            )
        )
    return reduce(DataFrame.unionByName, results)


#: Small enough to give several files at every given scale.
ROWS_PER_FILE = 1_000


@query(
    "k11_file_count",
    f"""
    SELECT count(*) AS n_rows, CAST(ceil(count(*) / {ROWS_PER_FILE}) AS BIGINT) AS n_files
    FROM orders
    """,
)
def file_count(spark, sf_dir):
    """As many files as the number of rows asks for."""
    path = new_path(spark, "orders-sized")
    orders = table(spark, sf_dir, "orders")
    files.write_files(orders, path, math.ceil(orders.count() / ROWS_PER_FILE))
    n_files = file_sizes(spark, path, ".parquet").agg(F.count(F.lit(1)))
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n_rows"), n_files.scalar().alias("n_files")
    )


@query("k12_partition_by", "SELECT l_returnflag, l_orderkey, l_quantity FROM lineitem")
def partition_by(spark, sf_dir):
    path = new_path(spark, "lineitem-by-flag")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    files.write_partitioned(lines, path, ["l_returnflag"])
    return spark.read.parquet(path)


@query(
    "k13_partition_by_two",
    """
    SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority, o_orderkey FROM orders
    """,
)
def partition_by_two(spark, sf_dir):
    """Two levels of folders, one of them with a folder for NULL."""
    path = new_path(spark, "orders-by-two")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        "o_orderpriority",
    )
    files.write_partitioned(orders, path, ["o_orderstatus", "o_orderpriority"])
    return spark.read.schema(orders.schema).parquet(path)


def _database(spark, label: str) -> str:
    name = new_name(label)
    tables.create_database(spark, name, new_path(spark, name))
    return name


@query(
    "k14_managed_table",
    """
    SELECT c_mktsegment, count(*) AS n_customers,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_balance
    FROM customer GROUP BY c_mktsegment
    """,
)
def managed_table(spark, sf_dir):
    name = f"{_database(spark, 'managed')}.customer"
    tables.create_managed(table(spark, sf_dir, "customer"), name)
    return spark.sql(f"""
        SELECT c_mktsegment, count(*) AS n_customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_balance
        FROM {name} GROUP BY c_mktsegment
    """)


@query("k15_external_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def external_table(spark, sf_dir):
    """The rows are still in the folder after the table is dropped."""
    suppliers = table(spark, sf_dir, "supplier")
    path = new_path(spark, "supplier-external")
    name = f"{_database(spark, 'external')}.supplier"
    tables.create_external(spark, name, suppliers.schema, path)
    tables.append(suppliers, name)
    tables.drop_table(spark, name)
    return spark.read.schema(suppliers.schema).parquet(path)


@query("k16_append_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def append_table(spark, sf_dir):
    """A table made of some rows, then added to by the writer and by INSERT."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    name = f"{_database(spark, 'append')}.customer"
    tables.create_managed(customers.filter("c_acctbal < 0"), name)
    middle = customers.filter("c_acctbal >= 0 AND c_acctbal < 5000")
    tables.append(middle.select("c_acctbal", "c_name", "c_custkey"), name)
    spark.sql(
        f"INSERT INTO {name} SELECT * FROM {{rest}}", rest=customers.filter("c_acctbal >= 5000")
    )
    return spark.table(name)


@query("k17_jdbc_write", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def jdbc_write(spark, sf_dir):
    url, properties = database_url(spark)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    name = new_name("part")
    types = {"createTableColumnTypes": "p_name VARCHAR(64)"}
    low, high, slices = key_slices(parts, "p_partkey")
    write_table(parts, url, name, connections=min(slices, 16), properties=properties | types)
    return read_range(spark, url, name, "p_partkey", low, high, slices, properties)


@query(
    "k18_create_and_drop",
    """
    SELECT 'kept' AS table_name, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'O'
    """,
)
def create_and_drop(spark, sf_dir):
    """Two tables in a new database, one of them dropped again."""
    database = _database(spark, "lifecycle")
    orders = table(spark, sf_dir, "orders")
    tables.create_managed(orders.filter("o_orderstatus = 'O'"), f"{database}.kept")
    tables.create_managed(orders.filter("o_orderstatus = 'F'"), f"{database}.dropped")
    tables.drop_table(spark, f"{database}.dropped")
    counts = [
        spark.table(f"{database}.{found.name}")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("table_name", F.lit(found.name))
        for found in spark.catalog.listTables(database)
    ]
    return reduce(DataFrame.unionByName, counts)

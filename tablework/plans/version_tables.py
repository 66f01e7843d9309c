"""Queries over a versioned table of orders.

Version 1 inserts all orders, version 2 deletes the small ones of one status, version 3 doubles
the price of the urgent ones that are left.
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import functions as F

from tablework.plans.registry import query, table
from tablework.sources.files import file_sizes
from tablework.versions import changes as v
from tablework.workspace import new_path

KEY = ["o_orderkey"]
COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"]
DELETED = "o_orderstatus = 'P' AND o_totalprice < 100000"
RAISED = "o_orderpriority = '1-URGENT'"

V1_SQL = f"SELECT {', '.join(COLUMNS)} FROM orders"
V2_SQL = f"{V1_SQL} WHERE NOT ({DELETED})"
V3_SQL = f"""SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
       CASE WHEN {RAISED} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE NOT ({DELETED})"""


def _at(version: int) -> datetime:
    return datetime(2024, 1, version, 12, 0)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*COLUMNS)


def _versioned_orders(spark, sf_dir) -> str:
    """The folder of the table after version 3."""
    path = new_path(spark, "orders-versions")
    v.write_version(_orders(spark, sf_dir), path, 1, "I", _at(1), KEY)
    deleted = v.deletion(v.read_changes(spark, path), KEY, DELETED)
    v.write_version(deleted, path, 2, "D", _at(2), KEY)
    live = v.snapshot(v.read_changes(spark, path), KEY)
    raised = live.filter(RAISED).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    v.write_version(raised, path, 3, "U", _at(3), KEY)
    return path


@query("v1_insert", V1_SQL)
def insert(spark, sf_dir):
    """Two inserts, two versions."""
    path = new_path(spark, "orders-inserts")
    for version, condition in enumerate(("o_orderstatus = 'F'", "o_orderstatus <> 'F'"), 1):
        rows = _orders(spark, sf_dir).filter(condition)
        v.write_version(rows, path, version, "I", _at(version), KEY)
    return v.snapshot(v.read_changes(spark, path), KEY)


@query("v2_delete", V2_SQL)
def delete(spark, sf_dir):
    path = new_path(spark, "orders-deletes")
    v.write_version(_orders(spark, sf_dir), path, 1, "I", _at(1), KEY)
    deleted = v.deletion(v.read_changes(spark, path), KEY, DELETED)
    v.write_version(deleted, path, 2, "D", _at(2), KEY)
    return v.snapshot(v.read_changes(spark, path), KEY)


@query("v3_snapshot", V3_SQL)
def latest_snapshot(spark, sf_dir):
    return v.snapshot(v.read_changes(spark, _versioned_orders(spark, sf_dir)), KEY)


@query("v4_as_of", V2_SQL)
def as_of(spark, sf_dir):
    return v.snapshot(v.read_changes(spark, _versioned_orders(spark, sf_dir)), KEY, as_of=2)


@query("v5_restore", V1_SQL)
def restore(spark, sf_dir):
    """Back to version 1 by a new version that holds only the differences."""
    path = _versioned_orders(spark, sf_dir)
    changes = v.read_changes(spark, path)
    number = v.next_version(spark, path)
    v.write_version(v.restoration(changes, KEY, 1), path, number, None, _at(number), KEY)
    return v.snapshot(v.read_changes(spark, path), KEY)


@query(
    "v6_history",
    f"""
    SELECT 1 AS version, 'I' AS op, count(*) AS n_rows, '2024-01-01 12:00:00' AS committed_at FROM orders
    UNION ALL SELECT 2, 'D', count(*), '2024-01-02 12:00:00' FROM orders WHERE {DELETED}
    UNION ALL SELECT 3, 'U', count(*), '2024-01-03 12:00:00' FROM orders WHERE {RAISED} AND NOT ({DELETED})
    """,
)
def history(spark, sf_dir):
    rows = v.history(v.read_changes(spark, _versioned_orders(spark, sf_dir)))
    return rows.select(
        F.col(v.VERSION).alias("version"),
        F.col(v.OP).alias("op"),
        "n_rows",
        F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss").alias("committed_at"),
    )


@query(
    "v7_retention",
    f"SELECT 2 AS version, * FROM ({V2_SQL}) UNION ALL SELECT 3, * FROM ({V3_SQL})",
)
def retention(spark, sf_dir):
    """Versions from 2 on can still be read after older changes are left behind."""
    path = new_path(spark, "orders-retained")
    v.write_retained(v.read_changes(spark, _versioned_orders(spark, sf_dir)), KEY, 2, path)
    kept = v.read_changes(spark, path)
    second, third = (
        v.snapshot(kept, KEY, as_of=version).withColumn("version", F.lit(version))
        for version in (2, 3)
    )
    return second.unionByName(third)


#: Bytes of a file, unless the table is so small that a sixteenth of it is less.
FILE_BYTES = 128 * 2**20


def _rows_per_file(spark, folder: str) -> int:
    """Rows that fill a file, by the measured bytes of the rows in ``folder``."""
    n_bytes = file_sizes(spark, folder, ".parquet").agg(F.sum("length")).first()[0]
    share = min(1 / 16, FILE_BYTES / n_bytes)
    return max(1, math.ceil(spark.read.parquet(folder).count() * share))


@query("v8_compact", V3_SQL)
def compact(spark, sf_dir):
    path, table_path = new_path(spark, "orders-compact"), _versioned_orders(spark, sf_dir)
    live = v.snapshot(v.read_changes(spark, table_path), KEY)
    v.compact(live, path, _rows_per_file(spark, table_path))
    return spark.read.parquet(path)


@query(
    "v8_compact_files",
    f"""
    SELECT count(*) AS n_rows, true AS fewer_files, true AS several_files, true AS within_size
    FROM ({V3_SQL})
    """,
)
def compact_files(spark, sf_dir):
    """File counts before and after, from a table scattered over many small files."""
    scattered, path = new_path(spark, "orders-scattered"), new_path(spark, "orders-compact")
    live = v.snapshot(v.read_changes(spark, _versioned_orders(spark, sf_dir)), KEY)
    live.repartition(64).write.parquet(scattered)
    rows_per_file = _rows_per_file(spark, scattered)
    v.compact(spark.read.parquet(scattered), path, rows_per_file)
    before = file_sizes(spark, scattered, ".parquet").count()
    rows = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"))
    n_files = F.count(F.lit(1))
    return rows.agg(
        F.sum("n").alias("n_rows"),
        # As many files as the rows ask for may be more than there were.
        (n_files <= F.greatest(F.lit(before), F.ceil(F.sum("n") / rows_per_file) + 8)).alias("fewer_files"),
        (n_files > 1).alias("several_files"),
        (F.max("n") <= rows_per_file).alias("within_size"),
    )


@query("v9_cluster", V1_SQL)
def cluster(spark, sf_dir):
    path = new_path(spark, "orders-clustered")
    orders = _orders(spark, sf_dir)
    rows_per_file = _rows_per_file(spark, f"{sf_dir}/orders.parquet")
    v.cluster(orders, path, ["o_custkey", "o_totalprice"], KEY, rows_per_file)
    return spark.read.parquet(path)


def _files_to_read(spark, path, column, n_values: int) -> int:
    """Files whose range holds a value, summed over values spread over the column's range."""
    ranges = spark.read.parquet(path).groupBy(F.input_file_name()).agg(
        F.min(column).alias("low"), F.max(column).alias("high")
    )
    low, high = ranges.agg(F.min("low"), F.max("high")).first()
    probes = [low + (high - low) * (i + 0.5) / n_values for i in range(n_values)]
    hits = [F.count_if(F.lit(value).between(F.col("low"), F.col("high"))) for value in probes]
    return sum(ranges.agg(*hits).first())


@query(
    "v9_cluster_files",
    """
    SELECT count(*) AS n_rows, true AS several_files, true AS o_custkey_narrower,
           true AS o_totalprice_narrower FROM orders
    """,
)
def cluster_files(spark, sf_dir):
    """Whether fewer files may hold a value than in a copy of as many files in no order."""
    columns = ["o_custkey", "o_totalprice"]
    clustered, plain = new_path(spark, "orders-clustered"), new_path(spark, "orders-plain")
    orders = _orders(spark, sf_dir)
    v.cluster(orders, clustered, columns, KEY, _rows_per_file(spark, f"{sf_dir}/orders.parquet"))
    n_files = file_sizes(spark, clustered, ".parquet").count()
    orders.repartition(n_files).write.parquet(plain)
    narrower = {
        f"{name}_narrower": F.lit(
            _files_to_read(spark, clustered, name, 20) < 0.8 * _files_to_read(spark, plain, name, 20)
        )
        for name in columns
    }
    counted = spark.read.parquet(clustered).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumns({"several_files": F.lit(n_files > 1)} | narrower)


UPSERT_SQL = f"""
    WITH current_rows AS ({V3_SQL}),
    changed AS (
      SELECT o_orderkey, o_custkey, o_orderdate, 'X' AS o_orderstatus, o_orderpriority, o_totalprice
      FROM current_rows WHERE o_totalprice > 400000
      UNION ALL
      SELECT o_orderkey + 1000000000000, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, o_totalprice
      FROM current_rows WHERE o_orderstatus = 'O')
    SELECT * FROM changed
    UNION ALL SELECT * FROM current_rows WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed)
    """


def _upserted_orders(spark, sf_dir) -> str:
    """The folder after a version that changes some orders and adds others."""
    path = _versioned_orders(spark, sf_dir)
    changes = v.read_changes(spark, path)
    live = v.snapshot(changes, KEY)
    changed = live.filter("o_totalprice > 400000").withColumn("o_orderstatus", F.lit("X"))
    added = live.filter("o_orderstatus = 'O'").withColumn(
        "o_orderkey", F.col("o_orderkey") + F.lit(1_000_000_000_000)
    )
    rows = v.upserting(changes, changed.unionByName(added), KEY)
    v.write_version(rows, path, 4, None, _at(4), KEY)
    return path


@query("v10_upsert", UPSERT_SQL)
def upsert(spark, sf_dir):
    return v.snapshot(v.read_changes(spark, _upserted_orders(spark, sf_dir)), KEY)


@query(
    "v10_upsert_history",
    f"""
    SELECT op, count(*) AS n_rows FROM (
      SELECT 'U' AS op FROM ({V3_SQL}) WHERE o_totalprice > 400000
      UNION ALL SELECT 'I' FROM ({V3_SQL}) WHERE o_orderstatus = 'O') GROUP BY op
    """,
)
def upsert_history(spark, sf_dir):
    """The version tells changed rows from new ones."""
    rows = v.history(v.read_changes(spark, _upserted_orders(spark, sf_dir)))
    return rows.where(F.col(v.VERSION) == 4).select(F.col(v.OP).alias("op"), "n_rows")


@query(
    "v11_schema_check",
    """
    SELECT attempt, verdict, count(*) AS n_rows
    FROM orders CROSS JOIN (VALUES ('declared', 'written'), ('reordered', 'written'), ('wrong type', 'refused'),
                                   ('extra column', 'refused'), ('missing column', 'refused')) a(attempt, verdict)
    WHERE attempt <> 'declared' OR o_orderstatus = 'F' GROUP BY attempt, verdict
    """,
)
def schema_check(spark, sf_dir):
    """Rows in the table after each attempt; refused writes leave it as it was."""
    orders = _orders(spark, sf_dir)
    path = new_path(spark, "orders-checked")
    attempts = {
        "declared": orders.filter("o_orderstatus = 'F'"),
        "reordered": orders.filter("o_orderstatus <> 'F'").select(*reversed(COLUMNS)),
        "wrong type": orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")),
        "extra column": orders.withColumn("note", F.lit("new")),
        "missing column": orders.drop("o_custkey"),
    }
    results = []
    for version, (attempt, rows) in enumerate(attempts.items(), 1):
        try:
            v.write_version(v.check_schema(rows, orders.schema), path, version, "I", _at(version), KEY)
            verdict = "written"
        except ValueError:
            verdict = "refused"
        results.append((attempt, verdict, v.read_changes(spark, path).count()))
    return spark.createDataFrame(results, "attempt string, verdict string, n_rows bigint")

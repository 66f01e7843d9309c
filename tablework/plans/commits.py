"""Queries over a table that several writers change."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import functions as F

from tablework.plans.registry import query, table
from tablework.versions.changes import OP, snapshot
from tablework.versions.commits import Delete, Insert, Update, committed_changes, merge_changes, records, transact
from tablework.workspace import new_path

KEY = ["o_orderkey"]
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
AT = datetime(2024, 1, 1)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*COLUMNS)


def _inserted(spark, sf_dir) -> str:
    path = new_path(spark, "orders-commits")
    transact(
        spark, path, KEY, lambda _: _orders(spark, sf_dir).withColumn(OP, F.lit("I")), "insert", AT
    )
    return path


def _by_two_writers(spark, sf_dir) -> str:
    """Two writers at a time raise customer numbers, of rows that are partly the same."""
    path = _inserted(spark, sf_dir)

    def raised(condition: str, amount: int):
        def build(changes):
            live = snapshot(changes, KEY).where(condition)
            return live.withColumns({"o_custkey": F.col("o_custkey") + amount, OP: F.lit("U")})

        return transact(spark, path, KEY, build, f"raise {amount}", AT)

    with ThreadPoolExecutor(2) as writers:
        done = [
            writers.submit(raised, "o_orderpriority = '1-URGENT'", 1_000_000),
            writers.submit(raised, "o_orderstatus = 'F'", 20_000_000),
        ]
        for writer in done:
            writer.result()
    return path


@query(
    "acid_two_writers",
    """
    SELECT o_orderkey, o_custkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 1000000 ELSE 0 END
               + CASE WHEN o_orderstatus = 'F' THEN 20000000 ELSE 0 END AS o_custkey,
           o_orderstatus, o_orderpriority, o_totalprice
    FROM orders
    """,
)
def two_writers(spark, sf_dir):
    """Neither writer's changes are lost, whoever commits first."""
    return snapshot(committed_changes(spark, _by_two_writers(spark, sf_dir)), KEY)


@query(
    "acid_commit_log",
    """
    SELECT 'insert' AS operation, 'I' AS op, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'raise 1000000', 'U', count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'raise 20000000', 'U', count(*) FROM orders WHERE o_orderstatus = 'F'
    """,
)
def commit_log(spark, sf_dir):
    """What each committed version changed; rows of attempts that met a conflict are not there."""
    path = _by_two_writers(spark, sf_dir)
    names = spark.createDataFrame(
        [(record.version, record.operation) for record in records(spark, path)],
        "_version bigint, operation string",
    )
    changes = committed_changes(spark, path).join(names, "_version")
    return changes.groupBy("operation", F.col(OP).alias("op")).agg(F.count("*").alias("n_rows"))


@query(
    "acid_merge",
    """
    WITH source AS (
        SELECT CASE WHEN o_orderstatus = 'O' THEN o_orderkey + 1000000000000 ELSE o_orderkey END AS k,
               o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P')
    SELECT o_orderkey, o.o_custkey,
           CASE WHEN k IS NOT NULL AND o.o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           o_orderpriority,
           CASE WHEN k IS NOT NULL AND o.o_totalprice > 300000 THEN s.o_totalprice * 2
                ELSE o.o_totalprice END AS o_totalprice
    FROM orders o LEFT JOIN source s ON s.k = o.o_orderkey
    WHERE CASE WHEN k IS NOT NULL THEN NOT o.o_totalprice < 50000
               ELSE NOT (o_orderpriority = '1-URGENT') END
    UNION ALL
    SELECT k, o_custkey, 'N', NULL, o_totalprice FROM source WHERE k >= 1000000000000 AND o_totalprice >= 100000
    """,
)
def merge(spark, sf_dir):
    """A MERGE with conditions on each clause, committed as one version."""
    path = _inserted(spark, sf_dir)
    moved = F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") + 1_000_000_000_000)
    source = (
        table(spark, sf_dir, "orders")
        .where("o_orderstatus <> 'P'")
        .select(moved.otherwise(F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", "o_totalprice")
    )

    def build(changes):
        return merge_changes(
            snapshot(changes, KEY),
            source,
            KEY,
            matched=[
                Delete(F.col("target.o_totalprice") < 50000),
                Update(
                    {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("source.o_totalprice") * 2},
                    F.col("target.o_totalprice") > 300000,
                ),
            ],
            not_matched=[
                Insert({"o_orderstatus": F.lit("N")}, F.col("source.o_totalprice") >= 100000)
            ],
            not_matched_by_source=[Delete(F.col("target.o_orderpriority") == "1-URGENT")],
        )

    transact(spark, path, KEY, build, "merge", AT)
    return snapshot(committed_changes(spark, path), KEY)

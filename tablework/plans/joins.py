"""Join and union queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.operators.combine import keyed_join, stack_batches, union_checked
from tablework.plans.registry import query, table


@query(
    "j1_inner_join",
    """
    SELECT l_orderkey, l_partkey, l_quantity, o_custkey, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def inner_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority"
    )
    return keyed_join(lines, orders, "l_orderkey")


@query(
    "j2_left_join",
    """
    SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment
    FROM events e LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 2000) c
      ON e.user_id = c.c_custkey
    """,
)
def left_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    customers = table(spark, sf_dir, "customer").filter("c_acctbal >= 2000")
    named = customers.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return keyed_join(events, named, "user_id", "left")


@query(
    "j3_null_safe_join",
    """
    SELECT c_custkey, n_name
    FROM (SELECT c_custkey, nullif(c_nationkey, 3) AS k FROM customer) c
    JOIN (SELECT nullif(n_nationkey, 3) AS k, n_name FROM nation) n
      ON c.k IS NOT DISTINCT FROM n.k
    """,
)
def null_safe_join(spark, sf_dir):
    """One nation is unknown on both sides and still found."""
    unknown = F.lit(3)
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_nationkey"), unknown).alias("nation")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.nullif(F.col("n_nationkey"), unknown).alias("nation"), "n_name"
    )
    return keyed_join(customers, nations, "nation", null_safe=True).select("c_custkey", "n_name")


@query(
    "j4_join_without_double_key",
    """
    SELECT s_suppkey, s_nationkey AS nation_key, n_name, r_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def join_without_double_key(spark, sf_dir):
    """The second key goes: by naming the join column, and by reference after the join."""
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation_key")
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nation_key")
    regions = table(spark, sf_dir, "region")
    named = suppliers.join(nations, on=["nation_key"])
    placed = named.join(regions, named.n_regionkey == regions.r_regionkey)
    return placed.drop(regions.r_regionkey).select("s_suppkey", "nation_key", "n_name", "r_name")


@query(
    "r12_union_by_position",
    """
    SELECT c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT s_suppkey, s_name FROM supplier
    """,
)
def union_by_position(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name")
    return union_checked(customers, suppliers)


@query(
    "r13_union_by_name",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
    """,
)
def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS balance", "s_name AS name", "s_suppkey AS id"
    )
    return customers.unionByName(suppliers)


@query(
    "r14_union_missing_columns",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT p_partkey, p_name, NULL FROM part
    """,
)
def union_missing_columns(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS name")
    return customers.unionByName(parts, allowMissingColumns=True)


@query(
    "r15_stack_batches",
    """
    SELECT 0 AS batch, conv_id AS id, text FROM conversations
    UNION ALL SELECT 1, item_id, text FROM benchmark
    UNION ALL SELECT 2, doc_id, text FROM documents
    """,
)
def stack_batches_query(spark, sf_dir):
    sources = [("conversations", "conv_id"), ("benchmark", "item_id"), ("documents", "doc_id")]
    return stack_batches(
        [
            table(spark, sf_dir, name).select(F.col(key).alias("id"), "text")
            for name, key in sources
        ]
    )

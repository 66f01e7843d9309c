"""Projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.values import money
from tablework.operators import project
from tablework.plans.registry import query, table


@query("c1_select", "SELECT c_name, c_mktsegment FROM customer")
def select(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_name", F.col("c_mktsegment"))


@query("c2_select_except", "SELECT * EXCLUDE (l_tax, l_linestatus, l_shipdate) FROM lineitem")
def select_except(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return project.select_except(lines, ["l_tax", "l_linestatus", "l_shipdate"])


@query(
    "c3_select_expr",
    """
    SELECT o_orderkey, o_custkey * 12 AS yearly, o_totalprice > 250000 AS is_large,
           upper(o_orderstatus) AS status FROM orders
    """,
)
def select_expr(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey * 12 AS yearly",
        "o_totalprice > 250000 AS is_large",
        "upper(o_orderstatus) AS status",
    )


@query(
    "c4_add_column",
    "SELECT s_suppkey, s_acctbal, s_acctbal >= 5000 AS is_rich FROM supplier",
)
def add_column(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return suppliers.withColumn("is_rich", F.col("s_acctbal") >= 5000)


@query(
    "c5_add_dependent_columns",
    """
    SELECT o_orderkey,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.10 AS DOUBLE) AS bonus,
           CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 1.10, 2) AS DOUBLE) AS with_bonus
    FROM orders
    """,
)
def add_dependent_columns(spark, sf_dir):
    """Later columns use earlier ones, in one projection."""
    return spark.sql(
        """
        SELECT o_orderkey,
               CAST(exact_bonus AS DOUBLE) AS bonus,
               CAST(round(exact_price + exact_bonus, 2) AS DOUBLE) AS with_bonus
        FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS exact_price,
                     exact_price * 0.10 AS exact_bonus FROM {orders})
        """,
        orders=table(spark, sf_dir, "orders"),
    )


@query("c6_replace_column", "SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem")
def replace_column(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return lines.withColumn("l_quantity", F.col("l_quantity").cast("bigint"))


@query("c7_alias", "SELECT p_name AS part_name, p_size * 12 AS yearly_size FROM part")
def alias(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("part_name"), (F.col("p_size") * 12).alias("yearly_size")
    )


@query(
    "c8_rename_many",
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal AS balance, c_mktsegment
    FROM customer
    """,
)
def rename_many(spark, sf_dir):
    names = {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"}
    return project.rename_columns(table(spark, sf_dir, "customer"), names)


@query("c9_drop_columns", "SELECT event_id, user_id, value FROM events")
def drop_columns(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.drop("props", "event_type").drop(events.ts)


@query(
    "c10_literals",
    "SELECT s_suppkey, 'checked' AS state, 'new,active' AS tags FROM supplier",
)
def literals(spark, sf_dir):
    tagged = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.lit("checked").alias("state"),
        F.array(F.lit("new"), F.lit("active")).alias("tag_list"),
    )
    return tagged.select("s_suppkey", "state", F.array_join("tag_list", ",").alias("tags"))


@query(
    "c11_expression_text",
    "SELECT l_orderkey, l_partkey, l_quantity * 2 + 1 AS doubled FROM lineitem",
)
def expression_text(spark, sf_dir):
    doubled = F.expr("l_quantity * 2 + 1").alias("doubled")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", doubled)


@query(
    "c12_nested_field",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
    """,
)
def nested_field(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    nested = events.withColumn("props", F.from_json("props", "k int"))
    return nested.select("event_id", "props.k")


@query(
    "c13_corrected_cells",
    """
    SELECT c_custkey,
           CASE WHEN c_custkey = 7 THEN 90.0
                WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice >= 450000)
                THEN (SELECT max(o_totalprice) FROM orders
                      WHERE o_custkey = c_custkey AND o_totalprice >= 450000)
                ELSE c_acctbal END AS c_acctbal
    FROM customer
    """,
)
def corrected_cells(spark, sf_dir):
    """Balances overwritten from a table of corrections, and one by its key."""
    corrections = (
        table(spark, sf_dir, "orders")
        .filter("o_totalprice >= 450000")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("c_acctbal"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    corrected = project.apply_corrections(customers, corrections, "c_custkey", "c_acctbal")
    return project.set_where(corrected, F.col("c_custkey") == 7, "c_acctbal", F.lit(90.0))


@query(
    "c14_arithmetic",
    """
    SELECT l_orderkey, l_partkey, l_quantity + 5 AS more, l_quantity >= 30 AS is_bulk,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                AS DOUBLE) AS net_price
    FROM lineitem
    """,
)
def arithmetic(spark, sf_dir):
    net = money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        (F.col("l_quantity") + 5).alias("more"),
        (F.col("l_quantity") >= 30).alias("is_bulk"),
        net.cast("double").alias("net_price"),
    )

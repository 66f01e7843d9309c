"""Filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.text import contains_any_case
from tablework.operators import predicates
from tablework.plans.derived import GAP_SQL, orders_with_gaps
from tablework.plans.registry import query, table


@query(
    "f1_comparison",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders "
    "WHERE o_totalprice > 200000 AND o_orderstatus <> 'P'",
)
def comparison(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") > 200000)
        .where(F.col("o_orderstatus") != "P")
        .select("o_orderkey", "o_orderstatus", "o_totalprice")
    )


@query(
    "f2_and_or_not",
    """
    SELECT c_custkey FROM customer
    WHERE (c_mktsegment = 'BUILDING' AND c_acctbal > 1000)
       OR (c_mktsegment = 'MACHINERY' AND NOT c_acctbal > 9000)
    """,
)
def and_or_not(spark, sf_dir):
    building, machinery = (F.col("c_mktsegment") == name for name in ("BUILDING", "MACHINERY"))
    balance = F.col("c_acctbal")
    wanted = (building & (balance > 1000)) | (machinery & ~(balance > 9000))
    return table(spark, sf_dir, "customer").filter(wanted).select("c_custkey")


@query(
    "f3_membership",
    """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
    """,
)
def membership(spark, sf_dir):
    """A short list as literals, a list that grows with the data as a semi join."""
    promo = table(spark, sf_dir, "part").filter("p_type = 'PROMO'")
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    lines = lines.select("l_orderkey", "l_partkey", "l_quantity")
    keys = promo.select(F.col("p_partkey").alias("l_partkey"))
    return predicates.keep_keys(lines, keys, "l_partkey")


@query("f4_like_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def like_prefix(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.col("p_name").like("red%")).select("p_partkey", "p_name")


@query(
    "f5_contains",
    """
    SELECT doc_id, contains(text, 'the') AS has_the FROM documents
    WHERE contains(lower(text), 'an')
    """,
)
def contains(spark, sf_dir):
    return (
        table(spark, sf_dir, "documents")
        .filter(contains_any_case("text", "AN"))
        .select("doc_id", F.col("text").contains("the").alias("has_the"))
    )


@query(
    "f6_between",
    "SELECT event_id, value FROM events WHERE value BETWEEN 10 AND 100",
)
def between(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("value").between(10, 100)).select("event_id", "value")


@query(
    "f7_null_tests",
    f"""
    SELECT o_orderkey, o_orderpriority FROM {GAP_SQL}
    WHERE o_totalprice IS NULL AND o_orderpriority IS NOT NULL
    """,
)
def null_tests(spark, sf_dir):
    return (
        orders_with_gaps(spark, sf_dir)
        .filter(F.col("o_totalprice").isNull() & F.col("o_orderpriority").isNotNull())
        .select("o_orderkey", "o_orderpriority")
    )


@query(
    "f8_condition_text",
    "SELECT p_partkey, p_brand FROM part WHERE p_size > 20 AND p_type = 'SMALL' OR p_brand = 'Brand#7'",
)
def condition_text(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .filter("p_size > 20 AND p_type = 'SMALL' OR p_brand = 'Brand#7'")
        .select("p_partkey", "p_brand")
    )


@query(
    "f9_parameters",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O'",
)
def parameters(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    condition = "o_totalprice > :least AND o_orderstatus = :status"
    return predicates.filter_with(rows, condition, {"least": 300000, "status": "O"}).drop("o_orderstatus")


@query(
    "f10_key_lookup",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 490000)
    """,
)
def key_lookup(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter(
        "o_orderpriority = '1-URGENT' AND o_totalprice > 490000"
    )
    wanted = urgent.select(F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return predicates.keep_keys(customers, wanted, "c_custkey")


@query(
    "f11_label_slice",
    "SELECT c_name, c_acctbal FROM customer WHERE c_name BETWEEN 'Customer#000000010' AND 'Customer#000000900'",
)
def label_slice(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_name", "c_acctbal")
    return predicates.label_slice(customers, "c_name", "Customer#000000010", "Customer#000000900")


@query(
    "f12_position_slice",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 40 OFFSET 10",
)
def position_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return predicates.position_slice(orders, ["o_totalprice", "o_orderkey"], 10, 50)


@query(
    "f13_remove_keys",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def remove_keys(spark, sf_dir):
    debtors = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    keys = debtors.select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return predicates.remove_keys(orders, keys, "o_custkey")

"""The flagship query: scan, pushed-down range filter, join, aggregation, sort."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.values import money
from tablework.plans.registry import query, table


@query(
    "segment_report",
    """
    SELECT c_mktsegment AS segment, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price,
           max(o_totalprice) AS highest_price
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_totalprice BETWEEN 100000 AND 400000
    GROUP BY c_mktsegment ORDER BY c_mktsegment
    """,
)
def segment_report(spark, sf_dir):
    """Orders per market segment.

    Orders are summed up per customer before they meet the customers, so what is joined is one
    row per customer however many orders a customer has.
    """
    per_customer = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice").between(100000, 400000))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(money("o_totalprice")).alias("total"),
            F.max("o_totalprice").alias("highest"),
        )
    )
    return (
        table(spark, sf_dir, "customer")
        .join(per_customer, "c_custkey")
        .groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(
            F.sum("n").alias("n_orders"),
            (F.sum("total").cast("double") / F.sum("n")).alias("mean_price"),
            F.max("highest").alias("highest_price"),
        )
        .orderBy("segment")
    )

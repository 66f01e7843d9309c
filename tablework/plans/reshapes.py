"""Pivot and unpivot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.values import money
from tablework.operators import reshape
from tablework.plans.derived import GAP_SQL, orders_with_gaps
from tablework.plans.registry import query, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "p1_pivot",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{name}') AS DOUBLE) AS {name}"
        for name in EVENT_TYPES
    )
    + " FROM events GROUP BY user_id",
)
def pivot(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", money("value").alias("value"))
    events = reshape.known_values(events, "event_type", EVENT_TYPES)
    wide = reshape.pivot_sum(events, ["user_id"], "event_type", EVENT_TYPES, "value")
    return wide.select("user_id", *[F.col(name).cast("double") for name in EVENT_TYPES])


@query(
    "p2_unpivot",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'l_discount' AS measure, l_discount AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'l_quantity', l_quantity FROM lineitem
    UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'l_tax', l_tax FROM lineitem
    """,
)
def unpivot(spark, sf_dir):
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return table(spark, sf_dir, "lineitem").unpivot(
        key, ["l_discount", "l_quantity", "l_tax"], "measure", "amount"
    )


@query(
    "p3_stack_unstack",
    f"""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM {GAP_SQL}
    WHERE o_orderstatus IS NOT NULL OR o_orderpriority IS NOT NULL
    """,
)
def stack_unstack(spark, sf_dir):
    """One row per filled cell and back; orders without any filled cell are gone."""
    cells = ["o_orderstatus", "o_orderpriority"]
    orders = orders_with_gaps(spark, sf_dir).select("o_orderkey", *cells)
    long = reshape.stack(orders, ["o_orderkey"], cells, "cell", "content")
    return reshape.unstack(long, ["o_orderkey"], cells, "cell", "content")

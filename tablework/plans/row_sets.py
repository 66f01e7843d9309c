"""Duplicates, orderings, slices, samples and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.values import money
from tablework.operators import rows, windows
from tablework.plans.derived import GAP_SQL, orders_with_gaps
from tablework.plans.registry import query, table
from tablework.workspace import checkpointed


@query("r1_distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def distinct_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query(
    "r2_first_per_key",
    """
    SELECT doc_id, text, lang, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
    """,
)
def first_per_key(spark, sf_dir):
    """One document per text, the one with the lowest key."""
    return rows.first_per_key(table(spark, sf_dir, "documents"), ["text"], ["doc_id"])


@query(
    "r3_flag_duplicates",
    """
    SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS is_duplicate
    FROM documents
    """,
)
def flag_duplicates(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rows.flag_duplicates(documents, ["text"], ["doc_id"]).drop("text")


@query(
    "r3_flag_repeated_rows",
    """
    SELECT l_orderkey, l_returnflag, l_linestatus,
           row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus) > 1 AS is_duplicate
    FROM lineitem
    """,
)
def flag_repeated_rows(spark, sf_dir):
    """All columns compared; NULL equals NULL, and the rows' own order is made for the purpose."""
    columns = ["l_orderkey", "l_returnflag", "l_linestatus"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    placed = checkpointed(lines.withColumn("place", F.monotonically_increasing_id()), "placed")
    return rows.flag_duplicates(placed, columns, ["place"]).drop("place")


@query(
    "r3_flag_null_key",
    f"""
    SELECT o_orderpriority, o_orderkey, row_number() OVER (
        PARTITION BY o_orderpriority ORDER BY o_orderkey NULLS FIRST) > 1 AS is_duplicate
    FROM (SELECT o_orderpriority, CASE WHEN o_orderkey > 0 THEN o_orderkey END AS o_orderkey FROM {GAP_SQL})
    """,
)
def flag_null_key(spark, sf_dir):
    """One row has no key; rows without priority are copies of each other."""
    key = F.when(F.col("o_orderkey") > 0, F.col("o_orderkey")).alias("o_orderkey")
    orders = orders_with_gaps(spark, sf_dir).select("o_orderpriority", key)
    return rows.flag_duplicates(orders, ["o_orderpriority"], ["o_orderkey"])


@query("r4_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort(spark, sf_dir):
    """The key makes the order total, and lets Spark cut a run of equal prices."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey")


@query(
    "r5_sort_mixed",
    """
    SELECT c_mktsegment, c_acctbal, c_custkey FROM customer
    ORDER BY c_mktsegment, c_acctbal DESC, c_custkey
    """,
)
def sort_mixed(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal", "c_custkey")
    return customers.sort(F.asc("c_mktsegment"), F.desc("c_acctbal"), "c_custkey")


@query(
    "r6_null_placement",
    f"SELECT o_orderkey, o_totalprice FROM {GAP_SQL} ORDER BY o_totalprice DESC NULLS LAST, o_orderkey",
)
def null_placement(spark, sf_dir):
    orders = orders_with_gaps(spark, sf_dir).select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey")


@query(
    "r7_top_k",
    "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25",
)
def top_k(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return events.orderBy(F.desc("value"), "event_id").limit(25)


@query(
    "r8_last_rows",
    "SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 20",
)
def last_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return rows.last_rows(events, ["ts", "event_id"], 20)


# The order of the categories, from small to large.
TYPE_ORDER = ["SMALL", "MEDIUM", "LARGE", "STANDARD", "ECONOMY", "PROMO"]


@query(
    "r9_category_order",
    """
    SELECT p_partkey, p_type, list_position(['SMALL', 'MEDIUM', 'LARGE', 'STANDARD', 'ECONOMY', 'PROMO'], p_type) AS place
    FROM part ORDER BY place, p_partkey
    """,
)
def category_order(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    placed = parts.withColumn("place", rows.category_rank("p_type", TYPE_ORDER).cast("int"))
    return rows.sort_by_category(placed, "p_type", TYPE_ORDER, ["p_partkey"])


@query(
    "r9_category_comparison",
    """
    SELECT p_partkey, list_position(['SMALL', 'MEDIUM', 'LARGE', 'STANDARD', 'ECONOMY', 'PROMO'], p_type) >= 3
        AS at_least_large
    FROM part
    """,
)
def category_comparison(spark, sf_dir):
    bound = rows.category_at_least("p_type", TYPE_ORDER, "LARGE")
    return table(spark, sf_dir, "part").select("p_partkey", bound.alias("at_least_large"))


def _sample_facts(whole, draw, key: str, low: float, high: float):
    """One row of what holds for any sample ``draw`` returns."""
    first, again = checkpointed(draw(), "sample"), checkpointed(draw(), "sample")
    strangers = first.join(whole.select(key), key, "left_anti").count()
    share = first.count() / whole.count()
    repeated = first.exceptAll(again).count() + again.exceptAll(first).count()
    return whole.agg(F.count(F.lit(1)).alias("n_rows")).withColumns(
        {
            "all_from_table": F.lit(strangers == 0),
            "same_with_seed": F.lit(repeated == 0),
            "size_in_bounds": F.lit(low < share < high),
        }
    )


@query(
    "r10_sample_seeded",
    """
    SELECT count(*) AS n_rows, true AS all_from_table, true AS same_with_seed,
           true AS size_in_bounds FROM orders
    """,
)
def sample_seeded(spark, sf_dir):
    """Three eighths of the rows; which ones depends on the seed and on the file layout."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return _sample_facts(
        orders, lambda: orders.sample(fraction=0.375, seed=2718), "o_orderkey", 0.3, 0.45
    )


@query(
    "r10_sample_by_key",
    "SELECT o_orderkey, o_custkey FROM orders WHERE substr(md5(o_orderkey::VARCHAR), 1, 8) < '40000000'",
)
def sample_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return rows.sample_by_key(orders, "o_orderkey", 0.25)


@query(
    "r11_sample_with_replacement",
    """
    SELECT count(*) AS n_rows, true AS all_from_table, true AS same_with_seed,
           true AS size_in_bounds FROM customer
    """,
)
def sample_with_replacement(spark, sf_dir):
    """More rows than there are, so that some come twice."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return _sample_facts(
        customers,
        lambda: customers.sample(withReplacement=True, fraction=2.25, seed=31),
        "c_custkey",
        1.75,
        2.75,
    )


@query(
    "w1_rolling_mean",
    """
    SELECT event_id, user_id,
           CASE WHEN count(*) OVER w = 3
                THEN CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / 3 END AS rolling_mean
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
)
def rolling_mean(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", money("value").alias("value")
    )
    result = windows.rolling_mean(events, ["user_id"], ["ts", "event_id"], "value", 3)
    return result.select("event_id", "user_id", "rolling_mean")


@query(
    "w1_rolling_mean_null_order",
    f"""
    SELECT o_orderkey, CASE WHEN count(*) OVER w = 3
               THEN CAST(sum(o_custkey) OVER w AS DOUBLE) / 3 END AS rolling_mean
    FROM {GAP_SQL}
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice NULLS FIRST, o_orderkey
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
)
def rolling_mean_null_order(spark, sf_dir):
    """Missing prices as order values, and orders without priority as a group."""
    order = ["o_totalprice", "o_orderkey"]
    orders = orders_with_gaps(spark, sf_dir)
    result = windows.rolling_mean(orders, ["o_orderpriority"], order, "o_custkey", 3)
    return result.select("o_orderkey", "rolling_mean")


@query(
    "window_ranks",
    """
    SELECT o_orderkey, o_orderstatus, row_number() OVER (w ORDER BY o_totalprice DESC, o_orderkey) AS row_no,
           rank() OVER (w ORDER BY o_totalprice DESC) AS rank_no,
           dense_rank() OVER (w ORDER BY o_totalprice DESC) AS dense_no
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus)
    """,
)
def window_ranks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    ranked = windows.ranked(orders, ["o_orderstatus"], "o_totalprice", "o_orderkey")
    return ranked.drop("o_totalprice")


@query(
    "window_lag_lead",
    """
    SELECT event_id, event_type, lag(value) OVER w AS previous, lead(value) OVER w AS following
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
    """,
)
def window_lag_lead(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    result = windows.lag_lead(events, ["event_type"], ["ts", "event_id"], "value")
    return result.select("event_id", "event_type", "previous", "following")


@query(
    "window_ranks_null_order",
    f"""
    SELECT o_orderkey, row_number() OVER (w ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS row_no,
           rank() OVER (w ORDER BY o_totalprice DESC NULLS LAST) AS rank_no,
           dense_rank() OVER (w ORDER BY o_totalprice DESC NULLS LAST) AS dense_no
    FROM {GAP_SQL} WINDOW w AS (PARTITION BY o_orderpriority)
    """,
)
def window_ranks_null_order(spark, sf_dir):
    orders = orders_with_gaps(spark, sf_dir)
    ranked = windows.ranked(orders, ["o_orderpriority"], "o_totalprice", "o_orderkey")
    return ranked.select("o_orderkey", "row_no", "rank_no", "dense_no")


@query(
    "window_lag_lead_null_order",
    f"""
    SELECT o_orderkey, lag(o_custkey) OVER w AS previous, lead(o_custkey) OVER w AS following
    FROM {GAP_SQL}
    WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice NULLS FIRST, o_orderkey)
    """,
)
def window_lag_lead_null_order(spark, sf_dir):
    order = ["o_totalprice", "o_orderkey"]
    result = windows.lag_lead(orders_with_gaps(spark, sf_dir), ["o_orderstatus"], order, "o_custkey")
    return result.select("o_orderkey", "previous", "following")

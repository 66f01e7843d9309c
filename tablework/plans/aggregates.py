"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.values import money
from tablework.operators import aggregate
from tablework.operators.quantiles import exact_percentiles
from tablework.plans.derived import GAP_SQL, orders_with_gaps
from tablework.plans.registry import query, table

EXACT = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def exact_sum(column: str):
    return F.sum(money(column)).cast("double")


@query(
    "a1_shape",
    "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns, count(*) = 0 AS is_empty FROM lineitem",
)
def shape(spark, sf_dir):
    return aggregate.shape(table(spark, sf_dir, "lineitem"))


@query(
    "a2_global",
    f"""
    SELECT {EXACT.format('o_totalprice')} / count(*) AS mean, max(o_totalprice) AS highest,
           min(o_totalprice) AS lowest, {EXACT.format('o_totalprice')} AS total FROM orders
    """,
)
def global_aggregates(spark, sf_dir):
    total = exact_sum("o_totalprice")
    return table(spark, sf_dir, "orders").agg(
        (total / F.count(F.lit(1))).alias("mean"),
        F.max("o_totalprice").alias("highest"),
        F.min("o_totalprice").alias("lowest"),
        total.alias("total"),
    )


@query(
    "a3_group_mean",
    f"""
    SELECT o_orderpriority, {EXACT.format('o_totalprice')} / count(o_totalprice) AS mean_price
    FROM {GAP_SQL} WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority
    """,
)
def group_mean(spark, sf_dir):
    """Missing group keys are left out, missing values do not count."""
    return (
        orders_with_gaps(spark, sf_dir)
        .filter(F.col("o_orderpriority").isNotNull())
        .groupBy("o_orderpriority")
        .agg((exact_sum("o_totalprice") / F.count("o_totalprice")).alias("mean_price"))
    )


@query(
    "a4_several_aggregates",
    f"""
    SELECT l_partkey, {EXACT.format('l_quantity')} / count(*) AS mean, max(l_quantity) AS highest,
           min(l_quantity) AS lowest, count(l_quantity) AS n FROM lineitem GROUP BY l_partkey
    """,
)
def several_aggregates(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            (exact_sum("l_quantity") / F.count(F.lit(1))).alias("mean"),
            F.max("l_quantity").alias("highest"),
            F.min("l_quantity").alias("lowest"),
            F.count("l_quantity").alias("n"),
        )
    )


@query(
    "a5_several_keys",
    f"""
    SELECT user_id, event_type, {EXACT.format('value')} AS total, count(*) AS n
    FROM events GROUP BY user_id, event_type
    """,
)
def several_keys(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type")
        .agg(exact_sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    )


A6_SQL = """
    SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price
    FROM {lines} GROUP BY l_returnflag, l_linestatus
"""


@query("a6_sql_group_by", A6_SQL.replace("{lines}", "lineitem"))
def sql_group_by(spark, sf_dir):
    return spark.sql(A6_SQL, lines=table(spark, sf_dir, "lineitem"))


@query(
    "a7_word_count",
    r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word
    """,
)
def word_count(spark, sf_dir):
    return aggregate.word_count(table(spark, sf_dir, "documents"), "text")


@query(
    "a8_value_counts",
    f"""
    SELECT o_orderstatus, count(*) AS n FROM {GAP_SQL}
    WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus ORDER BY n DESC, o_orderstatus
    """,
)
def value_counts(spark, sf_dir):
    return aggregate.value_counts(orders_with_gaps(spark, sf_dir), "o_orderstatus")


@query(
    "a9_count_distinct",
    """
    SELECT l_returnflag, count(DISTINCT l_shipdate) AS n_days, count(DISTINCT l_partkey) AS n_parts
    FROM lineitem GROUP BY l_returnflag
    """,
)
def count_distinct(spark, sf_dir):
    """Distinct values per group; each value leaves a task once."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_shipdate").alias("n_days"), F.count_distinct("l_partkey").alias("n_parts")
    )


@query("a9_distinct_values", "SELECT DISTINCT l_shipdate, l_returnflag FROM lineitem")
def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_shipdate", "l_returnflag").distinct()


@query(
    "a10_null_counts",
    f"""
    SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls FROM {GAP_SQL}
    UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM {GAP_SQL}
    UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM {GAP_SQL}
    UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM {GAP_SQL}
    UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM {GAP_SQL}
    """,
)
def null_counts(spark, sf_dir):
    return aggregate.null_counts(orders_with_gaps(spark, sf_dir))


PROFILED = ["l_quantity", "l_extendedprice", "l_linenumber"]


@query(
    "a11_numeric_profile",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count({name}) AS n, round(avg({name}), 6) AS mean,
        round(stddev_samp({name}), 6) AS stddev, CAST(min({name}) AS DOUBLE) AS low,
        CAST(max({name}) AS DOUBLE) AS high FROM lineitem"""
        for name in PROFILED
    ),
)
def numeric_profile(spark, sf_dir):
    profile = aggregate.numeric_profile(table(spark, sf_dir, "lineitem"), PROFILED)
    return profile.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


SHARES = [0.25, 0.5, 0.75, 0.9]


@query(
    "a12_percentiles",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, CAST({share} AS DOUBLE) AS share,
        round(quantile_cont(CAST({name} AS DOUBLE), {share}), 6) AS value FROM lineitem"""
        for name in PROFILED
        for share in SHARES
    ),
)
def percentiles(spark, sf_dir):
    exact = exact_percentiles(table(spark, sf_dir, "lineitem"), PROFILED, SHARES)
    return exact.withColumn("value", F.round("value", 6))


@query(
    "a13_impute_mean",
    f"""
    WITH g AS (SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM {GAP_SQL}),
    per_group AS (SELECT o_orderpriority AS p, CAST(sum(price) AS DOUBLE) / count(price) AS m FROM g GROUP BY 1)
    SELECT o_orderkey,
           round(coalesce(CAST(price AS DOUBLE), (SELECT CAST(sum(price) AS DOUBLE) / count(price) FROM g)), 2) AS by_mean,
           round(coalesce(CAST(price AS DOUBLE), m), 2) AS by_group
    FROM g LEFT JOIN per_group ON o_orderpriority IS NOT DISTINCT FROM p
    """,
)
def impute_mean(spark, sf_dir):
    """Missing prices as the mean of all, and as the mean of the same priority."""
    orders = orders_with_gaps(spark, sf_dir).select(
        "o_orderkey",
        "o_orderpriority",
        F.col("o_totalprice").alias("by_mean"),
        F.col("o_totalprice").alias("by_group"),
    )
    filled = aggregate.impute_mean(orders, "by_mean")
    filled = aggregate.impute_group_mean(filled, "by_group", "o_orderpriority")
    return filled.select(
        "o_orderkey",
        F.round("by_mean", 2).alias("by_mean"),
        F.round("by_group", 2).alias("by_group"),
    )


@query(
    "rollup",
    f"""
    SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus) + grouping(o_orderpriority) AS level,
           count(*) AS n, {EXACT.format('o_totalprice')} AS total
    FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
    """,
)
def rollup(spark, sf_dir):
    level = F.grouping("o_orderstatus").cast("bigint") + F.grouping("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .rollup("o_orderstatus", "o_orderpriority")
        .agg(
            level.alias("level"),
            F.count(F.lit(1)).alias("n"),
            exact_sum("o_totalprice").alias("total"),
        )
    )


@query(
    "cube",
    f"""
    SELECT c_mktsegment, c_nationkey, count(*) AS n, {EXACT.format('c_acctbal')} AS total
    FROM customer GROUP BY CUBE (c_mktsegment, c_nationkey)
    """,
)
def cube(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .cube("c_mktsegment", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("n"), exact_sum("c_acctbal").alias("total"))
    )

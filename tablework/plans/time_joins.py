"""Queries that join by nearness in time, by overlap and by order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.operators.theta import aggregate_below
from tablework.operators.time_joins import asof_join, interval_join
from tablework.plans.registry import query, table


def events_of(spark, sf_dir, kind: str, prefix: str):
    """Events of one type, their columns named apart."""
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select(
        "user_id",
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("ts").alias(f"{prefix}_at"),
        F.col("value").alias(f"{prefix}_value"),
    )


@query(
    "asof_last_view",
    """
    WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'),
         v AS (SELECT * FROM events WHERE event_type = 'view')
    SELECT p.user_id, p.event_id AS buy_id, p.ts AS buy_at, p.value AS buy_value,
           v.event_id AS view_id, v.ts AS view_at, v.value AS view_value
    FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
    """,
)
def last_view(spark, sf_dir):
    """Each purchase with the user's last view before it."""
    purchases = events_of(spark, sf_dir, "purchase", "buy")
    views = events_of(spark, sf_dir, "view", "view")
    return asof_join(purchases, views, ["user_id"], "buy_at", "view_at")


@query(
    "asof_next_click",
    """
    WITH v AS (SELECT * FROM events WHERE event_type = 'view'),
         c AS (SELECT * FROM events WHERE event_type = 'click')
    SELECT v.user_id, v.event_id AS view_id, v.ts AS view_at, v.value AS view_value,
           c.event_id AS click_id, c.ts AS click_at, c.value AS click_value
    FROM v ASOF JOIN c ON v.user_id = c.user_id AND v.ts < c.ts
    WHERE c.ts - v.ts <= INTERVAL 6 HOUR
    """,
)
def next_click(spark, sf_dir):
    """Each view with the user's next click, where it comes within six hours."""
    views = events_of(spark, sf_dir, "view", "view")
    clicks = events_of(spark, sf_dir, "click", "click")
    return asof_join(
        views, clicks, ["user_id"], "view_at", "click_at",
        direction="forward", strict=True, how="inner", tolerance=F.expr("INTERVAL 6 HOURS"),
    )


@query(
    "asof_without_key",
    """
    WITH e AS (SELECT event_id AS error_id, ts AS error_at FROM events WHERE event_type = 'error'),
         s AS (SELECT event_id AS signup_id, ts AS signup_at FROM events WHERE event_type = 'signup')
    SELECT e.error_id, e.error_at, s.signup_id, s.signup_at
    FROM e ASOF LEFT JOIN s ON e.error_at >= s.signup_at
    """,
)
def last_signup(spark, sf_dir):
    """Each error with the last signup of anybody: one key for all rows."""
    errors = events_of(spark, sf_dir, "error", "error").select("error_id", "error_at")
    signups = events_of(spark, sf_dir, "signup", "signup").select("signup_id", "signup_at")
    return asof_join(errors, signups, [], "error_at", "signup_at")


@query(
    "interval_point_in_range",
    """
    WITH e AS (SELECT user_id, event_id AS error_id, ts AS error_at,
                      ts + to_minutes(CAST(floor(value * 60) AS BIGINT)) AS error_until
               FROM events WHERE event_type = 'error'),
         o AS (SELECT user_id, event_id, ts, event_type FROM events WHERE event_type <> 'error')
    SELECT e.user_id, error_id, error_at, error_until, event_id, ts, event_type
    FROM e JOIN o ON e.user_id = o.user_id AND o.ts >= e.error_at AND o.ts < e.error_until
    """,
)
def point_in_range(spark, sf_dir):
    """What a user does while an error of theirs lasts, which takes minutes to weeks."""
    events = table(spark, sf_dir, "events")
    lasting = F.expr("make_dt_interval(0, 0, CAST(floor(value * 60) AS INT), 0)")
    errors = events.where("event_type = 'error'").select(
        "user_id",
        F.col("event_id").alias("error_id"),
        F.col("ts").alias("error_at"),
        (F.col("ts") + lasting).alias("error_until"),
    )
    others = events.where("event_type <> 'error'").select(
        "user_id", "event_id", "ts", "event_type", (F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).alias("after")
    )
    return interval_join(
        errors, others, ("error_at", "error_until"), ("ts", "after"), on=["user_id"], half_open=True
    ).drop("after")


@query(
    "interval_overlap",
    """
    WITH e AS (SELECT event_id, event_type, ts AS a, ts + to_seconds(floor(value * 3)) AS b FROM events)
    SELECT x.event_id AS error_id, count(*) AS n_purchases, min(y.event_id) AS first_id,
           max(y.event_id) AS last_id
    FROM e x JOIN e y ON x.event_type = 'error' AND y.event_type = 'purchase'
        AND x.a <= y.b AND y.a <= x.b
    GROUP BY x.event_id
    """,
)
def interval_overlap(spark, sf_dir):
    """How many purchases are under way while an error lasts; intervals of very different lengths."""
    spans = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.col("ts").alias("a"),
        (F.col("ts") + F.expr("make_dt_interval(0, 0, 0, floor(value * 3))")).alias("b"),
    )

    def of(kind, prefix):
        rows = spans.where(F.col("event_type") == kind)
        return rows.select(*[F.col(name).alias(f"{prefix}_{name}") for name in ("event_id", "a", "b")])

    met = interval_join(of("error", "x"), of("purchase", "y"), ("x_a", "x_b"), ("y_a", "y_b"))
    return met.groupBy(F.col("x_event_id").alias("error_id")).agg(
        F.count("*").alias("n_purchases"),
        F.min("y_event_id").alias("first_id"),
        F.max("y_event_id").alias("last_id"),
    )


@query(
    "theta_cheaper_orders",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate,
                      CAST(o_totalprice AS DECIMAL(18, 2)) AS price FROM orders)
    SELECT a.o_orderkey, a.o_custkey, a.price, count(b.o_orderkey) AS n_below,
           sum(b.price) AS sum_below, min(b.price) AS min_below, max(b.price) AS max_below
    FROM o a LEFT JOIN o b ON a.o_custkey = b.o_custkey AND b.price < a.price
    GROUP BY a.o_orderkey, a.o_custkey, a.price
    """,
)
def cheaper_orders(spark, sf_dir):
    """Each order with what its customer's cheaper orders come to."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    result = aggregate_below(orders, orders, "price", "price", "price", on=["o_custkey"])
    return result.withColumn("sum_below", F.col("sum_below").cast("decimal(38,2)"))


@query(
    "theta_richer_suppliers",
    """
    WITH s AS (SELECT CAST(s_acctbal AS DECIMAL(18, 2)) AS balance FROM supplier),
         c AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18, 2)) AS balance FROM customer)
    SELECT c_custkey, c.balance, count(s.balance) AS n_above, sum(s.balance) AS sum_above,
           min(s.balance) AS min_above, max(s.balance) AS max_above
    FROM c LEFT JOIN s ON s.balance >= c.balance
    GROUP BY c_custkey, c.balance
    """,
)
def richer_suppliers(spark, sf_dir):
    """Each customer with the suppliers that have at least their balance; no key at all."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").cast("decimal(18,2)").alias("funds")
    )
    result = aggregate_below(
        customers, suppliers, "balance", "funds", "funds", or_equal=True, above=True
    )
    return result.withColumn("sum_above", F.col("sum_above").cast("decimal(38,2)"))

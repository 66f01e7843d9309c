"""Queries by sketches, multisets, subqueries and recursion."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tablework.operators import sketches
from tablework.operators.multisets import except_all, intersect_all
from tablework.operators.recursion import paths, reachable
from tablework.operators.subqueries import beside_aggregates, having_related, top_related
from tablework.plans.registry import query, table
from tablework.workspace import new_path

#: Spans of days whose sketches are merged, with how they are called.
SPANS = [("all", date(2024, 1, 1), date(2024, 1, 31)), ("a week", date(2024, 1, 8), date(2024, 1, 14)),
         ("a day", date(2024, 1, 20), date(2024, 1, 20))]


@query(
    "sketches_by_day",
    """
    SELECT span, event_type, count(*) AS n_rows, true AS distinct_within, true AS quantiles_within,
           true AS items_within
    FROM events JOIN (VALUES ('all', DATE '2024-01-01', DATE '2024-01-31'),
                             ('a week', DATE '2024-01-08', DATE '2024-01-14'),
                             ('a day', DATE '2024-01-20', DATE '2024-01-20')) s(span, a, b)
        ON CAST(ts AS DATE) BETWEEN a AND b
    GROUP BY span, event_type
    """,
)
def sketches_by_day(spark, sf_dir):
    """Days sketched in two loads; merged spans against exact figures.

    Five standard errors of a distinct count, 2.5 % of the ranks of a quantile (with the ranks its
    value covers), and the guaranteed error of frequent items are allowed.
    """
    events = table(spark, sf_dir, "events")
    path = new_path(spark, "day-sketches")
    for half in ("day(ts) <= 12", "day(ts) > 12"):
        sketches.add_days(
            sketches.daily_sketches(
                events.where(half), F.to_date("ts"), ["event_type"],
                distinct=F.col("user_id"), value=F.col("value"), item=F.hour("ts"),
            ),
            path,
        )
    shares = [0.1, 0.5, 0.9]
    results = None
    for name, first, last in SPANS:
        estimate = sketches.merged(
            sketches.read_days(spark, path, first, last), ["event_type"], shares, 3
        )
        rows = events.where(F.to_date("ts").between(F.lit(first), F.lit(last)))
        beside = rows.join(estimate.select("event_type", "quantiles"), "event_type")
        known = beside.groupBy("event_type").agg(
            F.count("*").alias("n_exact"),
            F.count_distinct("user_id").alias("distinct_exact"),
            *[F.count_if(F.col("value") < F.col("quantiles")[i]).alias(f"below_{i}") for i in range(3)],
            *[F.count_if(F.col("value") <= F.col("quantiles")[i]).alias(f"upto_{i}") for i in range(3)],
        )
        hours = rows.groupBy("event_type", F.hour("ts").alias("item")).agg(F.count("*").alias("n"))
        counts = hours.groupBy("event_type").agg(
            F.map_from_entries(F.collect_list(F.struct("item", "n"))).alias("hours")
        )
        judged = estimate.join(known, "event_type").join(counts, "event_type")
        within = F.lit(True)
        for i, share in enumerate(shares):
            within = within & (F.col(f"below_{i}") <= (share + 0.025) * F.col("n_exact"))
            within = within & (F.col(f"upto_{i}") >= (share - 0.025) * F.col("n_exact"))
        slack = F.col("n_exact") / (0.75 * sketches.ITEMS_TRACKED)
        off = F.abs(F.col("distinct_exact") - F.col("n_distinct")) / F.col("distinct_exact")
        part = judged.select(
            F.lit(name).alias("span"),
            "event_type",
            "n_rows",
            (off <= 5 * 1.04 / 2 ** (sketches.REGISTERS_LOG / 2)).alias("distinct_within"),
            within.alias("quantiles_within"),
            F.forall(
                "top_items",
                lambda top: F.abs(F.element_at("hours", top["item"]) - top["count"]) <= slack,
            ).alias("items_within"),
        )
        results = part if results is None else results.unionAll(part)
    return results


LINES = """SELECT l_partkey % 50 AS part, CASE WHEN l_quantity > 25 THEN l_returnflag END AS flag
           FROM lineitem WHERE l_linestatus = '{}'"""


def _lines(spark, sf_dir, status):
    """Few distinct rows, each many times, NULL in some."""
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status)
    flag = F.when(F.col("l_quantity") > 25, F.col("l_returnflag"))
    return rows.select((F.col("l_partkey") % 50).alias("part"), flag.alias("flag"))


@query("intersect_all", f"{LINES.format('O')} INTERSECT ALL {LINES.format('F')}")
def intersect_all_query(spark, sf_dir):
    return intersect_all(_lines(spark, sf_dir, "O"), _lines(spark, sf_dir, "F"))


@query("except_all", f"{LINES.format('O')} EXCEPT ALL {LINES.format('F')}")
def except_all_query(spark, sf_dir):
    return except_all(_lines(spark, sf_dir, "O"), _lines(spark, sf_dir, "F"))


@query(
    "lateral_top_orders",
    """
    SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice, o.rank
    FROM customer c, LATERAL (
        SELECT o_orderkey, o_totalprice,
               CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
        FROM orders WHERE o_custkey = c.c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 3) o
    WHERE c.c_mktsegment = 'BUILDING'
    """,
)
def lateral_top_orders(spark, sf_dir):
    """The three dearest orders of each customer of a segment."""
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    return top_related(
        customers.select("c_custkey", "c_name"), orders, ["c_custkey"],
        [F.desc("o_totalprice"), F.asc("o_orderkey")], 3,
    )


@query(
    "correlated_above_mean",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
    WHERE CAST(o_totalprice AS DECIMAL(18, 2)) * (SELECT count(*) FROM orders i WHERE i.o_custkey = o.o_custkey)
        > (SELECT sum(CAST(o_totalprice AS DECIMAL(18, 2))) FROM orders i WHERE i.o_custkey = o.o_custkey)
    """,
)
def correlated_above_mean(spark, sf_dir):
    """Orders above the mean of their customer's orders, compared without rounding."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    beside = beside_aggregates(
        orders, orders, ["o_custkey"], [F.sum(price).alias("total"), F.count("*").alias("n")]
    )
    return beside.where(price * F.col("n") > F.col("total")).select(*orders.columns)


@query(
    "correlated_not_exists",
    """
    SELECT c_custkey, c_mktsegment FROM customer c WHERE NOT EXISTS (
        SELECT * FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 300000)
    """,
)
def correlated_not_exists(spark, sf_dir):
    """Customers without a dear order."""
    dear = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return having_related(
        customers, dear.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"], exists=False
    )


LINKS_SQL = """
    next_lines AS (
        SELECT l_suppkey AS source, lead(l_suppkey) OVER (
            PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) AS target
        FROM lineitem),
    counted AS (SELECT source, target, count(*) AS n FROM next_lines WHERE target IS NOT NULL GROUP BY ALL),
    links AS (SELECT source, target FROM counted
              QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, target) <= 2)
    """


def _supplier_links(spark, sf_dir):
    """Each supplier with the two suppliers that most often follow it on an order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    following = F.expr(
        "lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey)"
    )
    links = lines.select(F.col("l_suppkey").alias("source"), following.alias("target")).dropna()
    counted = links.groupBy("source", "target").agg(F.count("*").alias("n"))
    place = F.expr("row_number() OVER (PARTITION BY source ORDER BY n DESC, target)")
    return counted.withColumn("_place", place).where("_place <= 2").select("source", "target")


@query(
    "recursive_reach",
    f"""
    WITH RECURSIVE {LINKS_SQL},
    walk AS (
        SELECT s_suppkey AS node, 0 AS depth FROM supplier WHERE s_nationkey = 7
        UNION
        SELECT target, depth + 1 FROM walk JOIN links ON node = source WHERE depth < 60)
    SELECT node, min(depth) AS depth FROM walk GROUP BY node
    """,
)
def recursive_reach(spark, sf_dir):
    """Suppliers that follow those of a nation on orders, however many steps on; the links go in circles."""
    roots = table(spark, sf_dir, "supplier").where("s_nationkey = 7").select(F.col("s_suppkey").alias("node"))
    return reachable(_supplier_links(spark, sf_dir), roots, 60)


@query(
    "recursive_paths",
    f"""
    WITH RECURSIVE {LINKS_SQL},
    walk AS (
        SELECT s_suppkey AS root, s_suppkey AS node, 0 AS depth, [s_suppkey] AS path, false AS is_cycle
        FROM supplier WHERE s_nationkey = 7
        UNION ALL
        SELECT root, target, depth + 1, list_append(path, target), list_contains(path, target)
        FROM walk JOIN links ON node = source WHERE NOT is_cycle AND depth < 6)
    SELECT root, node, depth, array_to_string(path, '>') AS path, is_cycle FROM walk
    """,
)
def recursive_paths(spark, sf_dir):
    """Every walk of up to six steps, ended where it comes back to itself."""
    roots = table(spark, sf_dir, "supplier").where("s_nationkey = 7").select(F.col("s_suppkey").alias("node"))
    walks = paths(_supplier_links(spark, sf_dir), roots, 6)
    return walks.withColumn("path", F.array_join(F.col("path").cast("array<string>"), ">"))


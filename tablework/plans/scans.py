"""Queries over sources: files, databases, catalog tables, generated tables."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.values import money
from tablework.operators.aggregate import value_counts
from tablework.plans.derived import GAP_SQL, orders_with_gaps
from tablework.plans.embedded import database_url, key_slices
from tablework.plans.registry import query, table
from tablework.sinks.databases import write_table
from tablework.sinks.files import (
    write_csv,
    write_json,
    write_json_arrays,
    write_lines,
    write_partitioned,
)
from tablework.sinks.tables import create_database, create_managed
from tablework.sources import catalog, databases, files, generate
from tablework.workspace import new_name, new_path

EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


@query(
    "s1_lookup_rows",
    """
    SELECT l.label, count(*) AS n_orders
    FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) l(code, label)
      ON o_orderstatus = l.code
    GROUP BY l.label
    """,
)
def lookup_rows(spark, sf_dir):
    labels = generate.lookup(
        spark, [("F", "finished"), ("O", "open"), ("P", "partial")], ["code", "label"]
    )
    counts = value_counts(table(spark, sf_dir, "orders"), "o_orderstatus", "n_orders")
    return counts.join(labels, F.col("o_orderstatus") == F.col("code")).select("label", "n_orders")


@query(
    "s2_rows_as_mappings",
    """
    SELECT l.meaning, l.days, count(*) AS n_lines, sum(l_quantity) AS quantity
    FROM lineitem JOIN (VALUES ('A', 'accepted', 30), ('N', 'none', NULL), ('R', 'returned', 14)) l(code, meaning, days)
      ON l_returnflag = l.code
    GROUP BY l.meaning, l.days
    """,
)
def rows_as_mappings(spark, sf_dir):
    """Keys may stand in any order; a key that a row lacks is NULL."""
    flags = generate.lookup(
        spark,
        [
            {"code": "A", "meaning": "accepted", "days": 30},
            {"meaning": "none", "code": "N"},
            {"days": 14, "meaning": "returned", "code": "R"},
        ],
        "code string, meaning string, days int",
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    return lines.join(flags, F.col("l_returnflag") == F.col("code")).select(
        "meaning", "days", "n_lines", "quantity"
    )


@query(
    "s3_empty_accumulator",
    """
    SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations
    """,
)
def empty_accumulator(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars")
    )
    return generate.empty(spark, turns.schema).unionByName(turns)


@query("s4_csv_inferred", f"SELECT {EVENT_COLUMNS} FROM events")
def csv_inferred(spark, sf_dir):
    path = new_path(spark, "events-csv")
    write_csv(table(spark, sf_dir, "events"), path)
    inferred = files.read_csv_inferred(spark, path)
    # Inference takes times without zone for moments of the session's zone.
    return inferred.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("s5_csv_with_schema", f"SELECT {EVENT_COLUMNS} FROM events")
def csv_with_schema(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = new_path(spark, "events-csv")
    write_csv(events, path)
    return files.read_csv(spark, path, events.schema)


@query("s6_json_lines", f"SELECT {EVENT_COLUMNS} FROM events")
def json_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = new_path(spark, "events-json")
    write_json(events, path)
    return files.read_json(spark, path, events.schema)


@query("s7_json_arrays", "SELECT conv_id, turn, role, text FROM conversations")
def json_arrays(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    path = new_path(spark, "conversations-json")
    write_json_arrays(turns, path)
    return files.read_json(spark, path, turns.schema, multiLine="true")


@query(
    "s8_parquet_pushdown",
    """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount >= 0.05
    """,
)
def parquet_pushdown(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return lines.filter(late & (F.col("l_discount") >= 0.05)).select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


@query("s9_orc", "SELECT * FROM orders")
def orc(spark, sf_dir):
    path = new_path(spark, "orders-orc")
    table(spark, sf_dir, "orders").write.orc(path)
    return spark.read.orc(path)


@query(
    "s10_text_fields",
    """
    SELECT c_custkey, c_name, nullif(c_nationkey, 7) AS c_nationkey, c_acctbal,
           nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer
    """,
)
def text_fields(spark, sf_dir):
    """Fields between bars, some of them empty in the middle and at the end."""
    customers = table(spark, sf_dir, "customer").withColumns(
        {
            "c_nationkey": F.nullif(F.col("c_nationkey"), F.lit(7)),
            "c_mktsegment": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        }
    )
    path = new_path(spark, "customer-text")
    write_lines(customers, path, "|")
    return files.read_fields(spark, path, dict(customers.dtypes), "|")


@query(
    "s11_format_by_name",
    """
    SELECT f.kind, p_partkey, p_name, p_retailprice
    FROM part CROSS JOIN (VALUES ('csv'), ('json'), ('orc'), ('parquet')) f(kind)
    """,
)
def format_by_name(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    copies = []
    for kind in ("csv", "json", "orc", "parquet"):
        path = new_path(spark, f"part-{kind}")
        parts.write.format(kind).save(path)
        copies.append(files.read_any(spark, kind, path, parts.schema).withColumn("kind", F.lit(kind)))
    return reduce(DataFrame.unionByName, copies)


@query("s12_csv_pipe", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_pipe(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    path = new_path(spark, "supplier-pipe")
    write_csv(suppliers, path, sep="|")
    return files.read_csv(spark, path, suppliers.schema, sep="|")


@query(
    "s13_csv_options",
    f"""
    SELECT g.o_orderkey, g.o_orderstatus, g.o_totalprice,
           strftime(o.o_orderdate, '%Y-%m-%d') AS order_day,
           'said "' || o.o_orderpriority || '", twice' AS note
    FROM {GAP_SQL} g JOIN orders o ON o.o_orderkey = g.o_orderkey
    """,
)
def csv_options(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.concat(F.lit('said "'), "o_orderpriority", F.lit('", twice')).alias("note"),
    )
    path = new_path(spark, "orders-options")
    options = {"nullValue": "NA", "dateFormat": "dd/MM/yyyy", "sep": ";", "quote": "'", "escape": "\\"}
    write_csv(orders, path, **options)
    back = files.read_csv(spark, path, orders.schema, **options)
    return back.withColumn("order_day", F.date_format("order_day", "yyyy-MM-dd"))


@query(
    "s14_storage_uri",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 200000",
)
def storage_uri(spark, sf_dir):
    """A folder that a job wrote, read back under the full URI of its storage."""
    path = new_path(spark, "orders-by-uri")
    table(spark, sf_dir, "orders").write.parquet(path)
    uri = files.storage_uri(spark, path)
    return (
        files.read_any(spark, "parquet", uri)
        .filter(F.col("o_totalprice") > 200_000)
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@query(
    "s15_partition_pruned",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def partition_pruned(spark, sf_dir):
    path = new_path(spark, "orders-by-status")
    write_partitioned(table(spark, sf_dir, "orders"), path, ["o_orderstatus"])
    return (
        spark.read.parquet(path)
        .filter(F.col("o_orderstatus") == "F")
        .select("o_orderkey", "o_totalprice", "o_orderstatus")
    )


def _customers_in_database(spark, sf_dir):
    """A copy of the customers in a database; returns its URL and properties."""
    url, properties = database_url(spark)
    name = new_name("customer")
    types = {"createTableColumnTypes": "c_name VARCHAR(64), c_mktsegment VARCHAR(32)"}
    customers = table(spark, sf_dir, "customer")
    write_table(customers, url, name, properties=properties | types)
    return url, name, properties


@query("s16_jdbc_table", "SELECT * FROM customer")
def jdbc_table(spark, sf_dir):
    url, name, properties = _customers_in_database(spark, sf_dir)
    slices = key_slices(table(spark, sf_dir, "customer"), "c_custkey")
    return databases.read_range(spark, url, name, "c_custkey", *slices, properties)


@query(
    "s17_jdbc_query",
    """
    SELECT c_mktsegment AS segment, count(*) AS n_customers, max(c_acctbal) AS highest
    FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment
    """,
)
def jdbc_query(spark, sf_dir):
    url, name, properties = _customers_in_database(spark, sf_dir)
    sql = f"""
        SELECT "c_mktsegment" AS "segment", CAST(count(*) AS BIGINT) AS "n_customers",
               max("c_acctbal") AS "highest"
        FROM {name} WHERE "c_acctbal" > 0 GROUP BY "c_mktsegment"
    """
    return databases.read_query(spark, url, sql, properties)


@query("s18_jdbc_parallel", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 1000")
def jdbc_parallel(spark, sf_dir):
    url, name, properties = _customers_in_database(spark, sf_dir)
    slices = key_slices(table(spark, sf_dir, "customer"), "c_custkey")
    rows = databases.read_range(spark, url, name, "c_custkey", *slices, properties)
    return rows.filter(F.col("c_acctbal") >= 1000).select("c_custkey", "c_acctbal")


@query(
    "s19_catalog_scan",
    "SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_size > 25",
)
def catalog_scan(spark, sf_dir):
    database = new_name("scan")
    create_database(spark, database, new_path(spark, database))
    create_managed(table(spark, sf_dir, "part"), f"{database}.part")
    return spark.sql(
        f"SELECT p_partkey, p_brand, p_retailprice FROM {database}.part WHERE p_size > 25"
    )


@query(
    "s20_range_calendar",
    """
    WITH bounds AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
    days AS (SELECT lo + g.i::INTEGER AS day FROM bounds, generate_series(0, hi - lo) g(i))
    SELECT strftime(day, '%Y-%m-%d') AS day, count(o_orderkey) AS n_orders
    FROM days LEFT JOIN orders ON o_orderdate::DATE = day GROUP BY day
    """,
)
def range_calendar(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    counts = days.groupBy("day").agg(F.count(F.lit(1)).alias("n_orders"))
    return (
        generate.calendar(days, "day")
        .join(counts, "day", "left")
        .select(
            F.date_format("day", "yyyy-MM-dd").alias("day"),
            F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        )
    )


@query(
    "s21_pandas_frame",
    """
    SELECT o_orderkey, l.days, CAST(o_totalprice AS DOUBLE) * l.rate AS surcharge
    FROM orders LEFT JOIN (VALUES ('1-URGENT', 1, 0.5), ('2-HIGH', 3, 0.25), ('5-LOW', NULL, NULL)) l(priority, days, rate)
      ON o_orderpriority = l.priority
    """,
)
def pandas_frame(spark, sf_dir):
    """A short frame made in the program beside the orders; its gaps become NULL."""
    surcharges = pd.DataFrame(
        {
            "priority": ["1-URGENT", "2-HIGH", "5-LOW"],
            "days": pd.array([1, 3, None], "Int64"),
            "rate": [0.5, 0.25, float("nan")],
        }
    )
    rates = generate.lookup(spark, surcharges, "priority string, days int, rate double")
    orders = table(spark, sf_dir, "orders")
    return orders.join(rates, F.col("o_orderpriority") == F.col("priority"), "left").select(
        "o_orderkey",
        "days",
        (F.col("o_totalprice").cast("double") * F.col("rate")).alias("surcharge"),
    )


@query(
    "s22_running_totals",
    """
    SELECT count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events
    """,
)
def running_totals(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    path = new_path(spark, "events-csv")
    write_csv(events, path)
    return files.read_csv(spark, path, events.schema).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(money("value")).cast("double").alias("total")
    )


@query(
    "s23_catalog_listing",
    """
    SELECT 'customer' AS table_name, 'MANAGED' AS table_type, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'orders', 'MANAGED', count(*) FROM orders
    UNION ALL SELECT 'part', 'MANAGED', count(*) FROM part
    """,
)
def catalog_listing(spark, sf_dir):
    database = new_name("listing")
    create_database(spark, database, new_path(spark, database))
    for name in ("customer", "orders", "part"):
        create_managed(table(spark, sf_dir, name), f"{database}.{name}")
    return catalog.table_sizes(spark, database)

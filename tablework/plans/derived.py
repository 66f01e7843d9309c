"""Tables derived from the given ones, as DataFrames and as the SQL the oracles use.

The given tables hold no NULL, no malformed record and tidy text; these add them by rules on
the values, so that they keep every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.plans.registry import table

GAP_SQL = """(
  SELECT o_orderkey, o_custkey,
         nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_totalprice >= 50000 THEN o_totalprice END AS o_totalprice,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
  FROM orders)"""


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders where one status, one priority and small prices count as missing."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
    )


MESSY_SQL = """(
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_acctbal < 0 THEN '  ' || upper(c_name)
              WHEN c_acctbal < 5000 THEN lower(replace(c_name, '#', ' no ')) || '   '
              ELSE c_name END AS raw_name,
         CASE WHEN c_acctbal < -500 THEN NULL
              WHEN c_acctbal < 3000 THEN 'tel ' || lpad(c_custkey::VARCHAR, 11, '2')
              WHEN c_acctbal < 6000 THEN '(' || lpad(c_custkey::VARCHAR, 3, '5') || ') '
                   || lpad(c_custkey::VARCHAR, 4, '6') || ' ' || lpad(c_custkey::VARCHAR, 5, '7')
              ELSE lpad(c_custkey::VARCHAR, 2, '3') || '-' || lpad(c_custkey::VARCHAR, 5, '4') || '-'
                   || lpad(c_custkey::VARCHAR, 4, '8') END AS raw_phone,
         replace(c_name, '#', '.') || '@' || c_mktsegment || '.COM' AS mail
  FROM customer)"""


def messy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with untidy names, phone numbers in four formats and mail addresses."""
    name, balance = F.col("c_name"), F.col("c_acctbal")
    key = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        F.when(balance < 0, F.concat(F.lit("  "), F.upper(name)))
        .when(balance < 5000, F.concat(F.lower(F.replace(name, F.lit("#"), F.lit(" no "))), F.lit("   ")))
        .otherwise(name)
        .alias("raw_name"),
        F.when(balance < -500, F.lit(None))
        .when(balance < 3000, F.concat(F.lit("tel "), F.lpad(key, 11, "2")))
        .when(
            balance < 6000,
            F.concat(
                F.lit("("), F.lpad(key, 3, "5"), F.lit(") "), F.lpad(key, 4, "6"), F.lit(" "),
                F.lpad(key, 5, "7"),
            ),
        )
        .otherwise(F.concat_ws("-", F.lpad(key, 2, "3"), F.lpad(key, 5, "4"), F.lpad(key, 4, "8")))
        .alias("raw_phone"),
        F.concat(
            F.replace(name, F.lit("#"), F.lit(".")), F.lit("@"), F.col("c_mktsegment"), F.lit(".COM")
        ).alias("mail"),
    )


DATE_TEXT_SQL = """(
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%d.%m.%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day_text,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE o_custkey::VARCHAR END AS number_text
  FROM orders)"""


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with dates and numbers as strings, some of them not readable as such."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(
            F.col("o_orderpriority") == "4-NOT SPECIFIED",
            F.date_format("o_orderdate", "dd.MM.yyyy"),
        )
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("day_text"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("number_text"),
    )

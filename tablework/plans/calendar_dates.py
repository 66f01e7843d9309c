"""Date queries. Dates come out as text, so that they compare across engines."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from tablework.functions import dates
from tablework.plans.derived import DATE_TEXT_SQL, orders_as_text
from tablework.plans.registry import query, table

AS_OF = date(2002, 2, 28)
MOMENT = datetime(2002, 2, 28, 12, 30)


def _day_text(column):
    return F.date_format(column, "yyyy-MM-dd")


@query(
    "d1_parse_date",
    f"""
    SELECT o_orderkey, strftime(try_strptime(day_text, '%Y-%m-%d'), '%Y-%m-%d') AS day
    FROM {DATE_TEXT_SQL}
    """,
)
def parse_date(spark, sf_dir):
    rows = orders_as_text(spark, sf_dir)
    return rows.select("o_orderkey", _day_text(dates.parse_date("day_text")).alias("day"))


@query(
    "d2_as_of",
    """
    SELECT o_orderkey, '2002-02-28' AS today, '2002-02-28 12:30:00' AS moment,
           o_orderdate < TIMESTAMP '2002-02-28 12:30:00' AS is_past FROM orders
    """,
)
def as_of(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _day_text(dates.today(AS_OF)).alias("today"),
        F.date_format(dates.now(MOMENT), "yyyy-MM-dd HH:mm:ss").alias("moment"),
        (F.col("o_orderdate") < dates.now(MOMENT)).alias("is_past"),
    )


@query(
    "d2_today",
    "SELECT count(*) AS n_rows, true AS today_is_now, true AS moment_is_now, true AS all_past FROM orders",
)
def live_today(spark, sf_dir):
    """The session's own day and moment, against the driver's clock (a day apart at midnight)."""
    clock = datetime.now(timezone.utc).replace(tzinfo=None)
    near = [F.lit(clock.date() + timedelta(days=day)) for day in (-1, 0, 1)]
    apart = F.datediff(dates.now(), F.lit(clock.isoformat(sep=" ")).cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(dates.today().isin(near)).alias("today_is_now"),
        F.bool_and(F.abs(apart) <= 1).alias("moment_is_now"),
        F.bool_and(F.col("o_orderdate") < dates.now()).alias("all_past"),
    )


@query(
    "d3_date_parts",
    """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
           CAST(day(ts) AS INTEGER) AS d FROM events
    """,
)
def date_parts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d")
    )


@query("d4_weekday", "SELECT o_orderkey, dayname(o_orderdate) AS weekday FROM orders")
def weekday(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.weekday_name("o_orderdate").alias("weekday")
    )


@query(
    "d5_add_and_subtract_days",
    """
    SELECT o_orderkey, strftime(o_orderdate::DATE + 45, '%Y-%m-%d') AS later,
           strftime(o_orderdate::DATE - 17, '%Y-%m-%d') AS earlier FROM orders
    """,
)
def add_and_subtract_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _day_text(F.date_add(F.col("o_orderdate").cast("date"), 45)).alias("later"),
        _day_text(F.date_sub(F.col("o_orderdate").cast("date"), 17)).alias("earlier"),
    )


@query(
    "d6_days_between",
    """
    SELECT l_orderkey, l_partkey,
           CAST(date_diff('day', l_shipdate::DATE, DATE '2002-02-28') AS INTEGER) AS days FROM lineitem
    """,
)
def days_between(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", dates.days_since("l_shipdate", AS_OF).alias("days")
    )


@query(
    "d7_months_between",
    """
    SELECT o_orderkey,
           CASE WHEN day(d) = 28 OR last_day(d) = d THEN CAST(whole AS DOUBLE)
                ELSE round(whole + (28 - day(d)) / 31.0::DOUBLE, 8) END AS months
    FROM (SELECT o_orderkey, o_orderdate::DATE AS d,
                 (2002 - year(o_orderdate)) * 12 + 2 - month(o_orderdate) AS whole FROM orders)
    """,
)
def months_between(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.months_since("o_orderdate", AS_OF).alias("months")
    )


@query(
    "d8_date_format",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS dotted,
           strftime(o_orderdate, '%A, %d %B') AS spoken, strftime(o_orderdate, '%j/%y') AS day_of_year
    FROM orders
    """,
)
def date_format(spark, sf_dir):
    patterns = {"dotted": "yyyy.MM.dd", "spoken": "EEEE, dd MMMM", "day_of_year": "DDD/yy"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[F.date_format("o_orderdate", pattern).alias(name) for name, pattern in patterns.items()],
    )

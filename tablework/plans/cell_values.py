"""Conditions, casts, nested values, missing values and arbitrary functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from tablework.functions import udfs, values
from tablework.plans.derived import (
    DATE_TEXT_SQL,
    GAP_SQL,
    orders_as_text,
    orders_with_gaps,
)
from tablework.plans.registry import query, table


@query(
    "n1_round",
    """
    SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.10, 2) AS DOUBLE) AS tax
    FROM orders
    """,
)
def round_half_up(spark, sf_dir):
    tax = F.round(values.money("o_totalprice") * F.expr("0.10"), 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", tax.cast("double").alias("tax"))


@query(
    "n2_two_branches",
    f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'to do' END AS state FROM {GAP_SQL}",
)
def two_branches(spark, sf_dir):
    """A NULL status fails the test and falls to the other branch."""
    state = F.when(F.col("o_orderstatus") == "F", "closed").otherwise("to do")
    return orders_with_gaps(spark, sf_dir).select("o_orderkey", state.alias("state"))


@query(
    "n3_first_match",
    f"""
    SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN 'no quote' WHEN o_totalprice >= 350000 THEN 'board approval'
                            WHEN o_totalprice >= 120000 THEN 'two signatures'
                            WHEN o_totalprice >= 75000 THEN 'one signature' ELSE 'petty cash' END AS approval
    FROM {GAP_SQL}
    """,
)
def first_match(spark, sf_dir):
    steps = [(350000, "board approval"), (120000, "two signatures"), (75000, "one signature")]
    approval = values.band("o_totalprice", steps, "petty cash", "no quote")
    return orders_with_gaps(spark, sf_dir).select("o_orderkey", approval.alias("approval"))


@query(
    "n4_several_columns",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
                                 AND o_orderdate < TIMESTAMP '1998-01-01' THEN 'overdue'
                            WHEN o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' THEN 'watch'
                            ELSE 'done' END AS follow_up
    FROM orders
    """,
)
def several_columns(spark, sf_dir):
    is_open, priority = F.col("o_orderstatus") == "O", F.col("o_orderpriority")
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    overdue = is_open & priority.isin("1-URGENT", "2-HIGH") & old
    follow_up = (
        F.when(overdue, "overdue").when(is_open | (priority == "1-URGENT"), "watch").otherwise("done")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", follow_up.alias("follow_up"))


@query(
    "n5_no_otherwise",
    "SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'promoted' END AS state FROM part",
)
def no_otherwise(spark, sf_dir):
    state = F.when(F.col("p_type") == "PROMO", "promoted")
    return table(spark, sf_dir, "part").select("p_partkey", state.alias("state"))


@query(
    "n6_sql_case",
    "SELECT event_id, CASE WHEN value > 100 THEN 'big' WHEN value > 50 THEN 'mid' ELSE 'small' END AS size FROM events",
)
def sql_case(spark, sf_dir):
    size = F.expr("CASE WHEN value > 100 THEN 'big' WHEN value > 50 THEN 'mid' ELSE 'small' END")
    return table(spark, sf_dir, "events").select("event_id", size.alias("size"))


@query(
    "n7_mapped_values",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status,
           CASE WHEN o_custkey >= 1000 THEN 'late joiner' WHEN o_custkey >= 50 THEN 'settled' ELSE 'founder' END AS cohort
    FROM orders
    """,
)
def mapped_values(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        values.mapped("o_orderstatus", {"F": "finished", "O": "open"}).alias("status"),
        values.band("o_custkey", [(1000, "late joiner"), (50, "settled")], "founder").alias("cohort"),
    )


@query(
    "n8_cast",
    """
    SELECT l_orderkey, CAST(l_orderkey AS VARCHAR) AS key_text, CAST(l_linenumber AS DOUBLE) AS line,
           CAST(trunc(l_quantity) AS INTEGER) AS quantity FROM lineitem
    """,
)
def cast(spark, sf_dir):
    """By type name and by type object."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_orderkey").cast("string").alias("key_text"),
        F.col("l_linenumber").cast(DoubleType()).alias("line"),
        F.col("l_quantity").cast(IntegerType()).alias("quantity"),
    )


@query(
    "n9_cast_date",
    f"""
    SELECT o_orderkey, strftime(TRY_CAST(day_text AS DATE), '%d.%m.%Y') AS day FROM {DATE_TEXT_SQL}
    """,
)
def cast_date(spark, sf_dir):
    day = values.tolerant_cast("day_text", "date")
    return orders_as_text(spark, sf_dir).select("o_orderkey", F.date_format(day, "dd.MM.yyyy").alias("day"))


@query(
    "n10_tolerant_cast",
    f"SELECT o_orderkey, TRY_CAST(number_text AS INTEGER) AS number FROM {DATE_TEXT_SQL}",
)
def tolerant_cast(spark, sf_dir):
    number = values.tolerant_cast("number_text", "int")
    return orders_as_text(spark, sf_dir).select("o_orderkey", number.alias("number"))


@query(
    "y1_array_element",
    """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2) AS second_word,
           CAST(NULL AS VARCHAR) AS ninth_word FROM part
    """,
)
def array_element(spark, sf_dir):
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        words[0].alias("first_word"),
        F.get(words, F.lit(1)).alias("second_word"),
        F.get(words, F.lit(8)).alias("ninth_word"),
    )


@query(
    "y2_explode",
    r"""
    SELECT conv_id, turn, CAST(place - 1 AS INTEGER) AS position, words[place] AS word
    FROM (SELECT conv_id, turn, words, unnest(generate_series(1, len(words))) AS place
          FROM (SELECT conv_id, turn, string_split(text, ' ') AS words FROM conversations))
    """,
)
def explode(spark, sf_dir):
    words = F.posexplode(F.split("text", " ")).alias("position", "word")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", words)


@query(
    "y3_build_nested",
    """
    SELECT s_suppkey, s_name || '/' || s_nationkey AS joined, s_acctbal AS balance, s_nationkey AS nation,
           CAST(NULL AS DOUBLE) AS missing, CAST(2 AS INTEGER) AS n_tags FROM supplier
    """,
)
def build_nested(spark, sf_dir):
    """Array, map and struct columns, and what is read from them."""
    nested = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.array("s_name", F.col("s_nationkey").cast("string")).alias("tags"),
        F.create_map(F.lit("balance"), F.col("s_acctbal")).alias("amounts"),
        F.struct(F.col("s_nationkey").alias("nation"), "s_name").alias("place"),
    )
    return nested.select(
        "s_suppkey",
        F.array_join("tags", "/").alias("joined"),
        F.col("amounts").getItem("balance").alias("balance"),
        F.col("place.nation").alias("nation"),
        F.try_element_at("amounts", F.lit("other")).alias("missing"),
        F.size("tags").alias("n_tags"),
    )


@query(
    "y4_json_fields",
    """
    SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1
    """,
)
def json_fields(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select(F.from_json("props", "k int").alias("p"))
    return parsed.groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


GAPPED = ["o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(
    "u1_drop_any_null",
    f"""
    SELECT o_orderkey FROM {GAP_SQL}
    WHERE o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
    """,
)
def drop_any_null(spark, sf_dir):
    return orders_with_gaps(spark, sf_dir).na.drop().select("o_orderkey")


@query(
    "u2_drop_all_null",
    f"""
    SELECT o_orderstatus, o_totalprice, o_orderpriority FROM {GAP_SQL}
    WHERE o_orderstatus IS NOT NULL OR o_totalprice IS NOT NULL OR o_orderpriority IS NOT NULL
    """,
)
def drop_all_null(spark, sf_dir):
    return orders_with_gaps(spark, sf_dir).select(*GAPPED).na.drop(how="all")


@query(
    "u3_drop_subset",
    f"SELECT o_orderkey, o_orderstatus FROM {GAP_SQL} WHERE o_totalprice IS NOT NULL",
)
def drop_subset(spark, sf_dir):
    rows = orders_with_gaps(spark, sf_dir).na.drop(subset=["o_totalprice"])
    return rows.select("o_orderkey", "o_orderstatus")


@query(
    "u4_drop_threshold",
    f"""
    SELECT o_orderkey FROM {GAP_SQL}
    WHERE (o_orderstatus IS NOT NULL)::INT + (o_totalprice IS NOT NULL)::INT
          + (o_orderpriority IS NOT NULL)::INT >= 2
    """,
)
def drop_threshold(spark, sf_dir):
    return orders_with_gaps(spark, sf_dir).na.drop(thresh=2, subset=GAPPED).select("o_orderkey")


@query(
    "u5_fill_value",
    f"SELECT o_orderkey, coalesce(o_orderstatus, 'unknown') AS o_orderstatus, o_orderpriority FROM {GAP_SQL}",
)
def fill_value(spark, sf_dir):
    rows = orders_with_gaps(spark, sf_dir).na.fill("unknown", subset=["o_orderstatus"])
    return rows.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "u6_fill_by_column",
    f"""
    SELECT o_orderkey, coalesce(o_orderstatus, 'unknown') AS o_orderstatus,
           coalesce(o_totalprice, 0) AS o_totalprice, coalesce(o_orderpriority, 'none') AS o_orderpriority
    FROM {GAP_SQL}
    """,
)
def fill_by_column(spark, sf_dir):
    filled = {"o_orderstatus": "unknown", "o_totalprice": 0, "o_orderpriority": "none"}
    return orders_with_gaps(spark, sf_dir).na.fill(filled).select("o_orderkey", *filled)


@query(
    "u7_coalesce",
    f"""
    SELECT o_orderkey, coalesce(o_orderpriority, o_orderstatus, 'nothing known') AS best FROM {GAP_SQL}
    """,
)
def coalesce(spark, sf_dir):
    best = F.coalesce("o_orderpriority", "o_orderstatus", F.lit("nothing known"))
    return orders_with_gaps(spark, sf_dir).select("o_orderkey", best.alias("best"))


@query(
    "g1_map_filter_flat_map",
    r"""
    SELECT word, length(word) AS n_chars
    FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) WHERE length(word) > 3
    """,
)
def map_filter_flat_map(spark, sf_dir):
    """Element functions as expressions on arrays, then one row per element."""
    words = F.transform(F.split("p_name", " "), lambda word: F.lower(word))
    long_words = F.filter(words, lambda word: F.length(word) > 3)
    rows = table(spark, sf_dir, "part").select(F.explode(long_words).alias("word"))
    return rows.withColumn("n_chars", F.length("word").cast("bigint"))


#: Whole numbers from here on have no exact double.
BIG = 2**53


@query(
    "g2_value_function",
    f"""
    SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'none'
                           ELSE CAST(1 + ({BIG} + c_custkey - 1) % 9 AS VARCHAR) END AS root
    FROM customer
    """,
)
def value_function(spark, sf_dir):
    """A loop no built-in has: sums of digits until one digit is left, on numbers and NULL."""

    def digital_root(number):
        if number is None:
            return "none"
        while number > 9:
            number = sum(map(int, str(number)))
        return str(number)

    number = F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey") + F.lit(BIG))
    root = udfs.value_function(digital_root, "string")
    return table(spark, sf_dir, "customer").select("c_custkey", root(number).alias("root"))


@query(
    "g3_row_function",
    f"""
    SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN {BIG} + s_suppkey END AS number,
           CASE WHEN s_suppkey % 5 <> 0 THEN gcd({BIG} + s_suppkey, s_nationkey + 6) END AS common
    FROM supplier WHERE s_suppkey % 3 <> 0
    """,
)
def row_function(spark, sf_dir):
    """Whole rows through Python: Euclid's loop, no row at all for some, large numbers and NULL."""

    def common_divisor(row):
        if row["s_suppkey"] % 3 == 0:
            return
        number, rest = row["number"], row["s_nationkey"] + 6
        if number is not None:
            larger = number
            while rest:
                larger, rest = rest, larger % rest
            yield {"s_suppkey": row["s_suppkey"], "number": number, "common": larger}
        else:
            yield {"s_suppkey": row["s_suppkey"], "number": None, "common": None}

    number = F.when(F.col("s_suppkey") % 5 != 0, F.col("s_suppkey") + F.lit(BIG))
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", number.alias("number")
    )
    return udfs.map_rows(suppliers, common_divisor, "s_suppkey bigint, number bigint, common bigint")

"""String queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions import text
from tablework.plans.derived import MESSY_SQL, messy_customers
from tablework.plans.registry import query, table


@query(
    "x1_upper_lower",
    """
    SELECT c_custkey, upper(c_name) AS name_upper, lower(c_mktsegment) AS segment_lower FROM customer
    """,
)
def upper_lower(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.upper("c_name").alias("name_upper"),
        F.lower("c_mktsegment").alias("segment_lower"),
    )


@query(
    "x2_title_case",
    f"""
    SELECT c_custkey,
           array_to_string(list_transform(string_split(trim(raw_name), ' '),
             lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name
    FROM {MESSY_SQL}
    """,
)
def title_case(spark, sf_dir):
    return messy_customers(spark, sf_dir).select("c_custkey", text.title_case("raw_name").alias("name"))


@query(
    "x3_trim",
    f"""
    SELECT c_custkey, trim(raw_name) AS both, ltrim(raw_name) AS front, rtrim(raw_name) AS back
    FROM {MESSY_SQL}
    """,
)
def trim(spark, sf_dir):
    return messy_customers(spark, sf_dir).select(
        "c_custkey",
        F.trim("raw_name").alias("both"),
        F.ltrim("raw_name").alias("front"),
        F.rtrim("raw_name").alias("back"),
    )


@query("x4_length", "SELECT doc_id, length(text) AS n_chars FROM documents")
def length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("bigint").alias("n_chars"))


@query(
    "x5_concat",
    f"SELECT c_custkey, trim(raw_name) || ' ~ ' || raw_phone AS label FROM {MESSY_SQL}",
)
def concat(spark, sf_dir):
    """NULL as soon as one part is NULL."""
    label = F.concat(F.trim("raw_name"), F.lit(" ~ "), "raw_phone")
    return messy_customers(spark, sf_dir).select("c_custkey", label.alias("label"))


@query(
    "x6_concat_ws",
    f"""
    SELECT c_custkey, concat_ws(' / ', trim(raw_name), raw_phone, c_mktsegment) AS label
    FROM {MESSY_SQL}
    """,
)
def concat_ws(spark, sf_dir):
    """NULL parts are left out."""
    label = F.concat_ws(" / ", F.trim("raw_name"), "raw_phone", "c_mktsegment")
    return messy_customers(spark, sf_dir).select("c_custkey", label.alias("label"))


@query("x7_substring", "SELECT page_id, substring(url, 1, 12) AS start FROM pages")
def substring(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.substring("url", 1, 12).alias("start"))


@query(
    "x8_split",
    f"""
    SELECT c_custkey, split_part(mail, '@', 1) AS user_name, split_part(mail, '@', 2) AS domain,
           CAST(NULL AS VARCHAR) AS third
    FROM {MESSY_SQL}
    """,
)
def split(spark, sf_dir):
    return messy_customers(spark, sf_dir).select(
        "c_custkey",
        text.part("mail", "@", 0).alias("user_name"),
        text.part("mail", "@", 1).alias("domain"),
        text.part("mail", "@", 2).alias("third"),
    )


@query(
    "x9_digits_only",
    f"SELECT c_custkey, regexp_replace(raw_phone, '[^0-9]', '', 'g') AS phone FROM {MESSY_SQL}",
)
def digits_only(spark, sf_dir):
    return messy_customers(spark, sf_dir).select("c_custkey", text.digits_only("raw_phone").alias("phone"))


@query(
    "x10_mask_mail",
    "SELECT doc_id, regexp_replace(text, '[A-Za-z0-9._%+-]+@', '***@', 'g') AS text FROM documents",
)
def mask_mail(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.mask_mail("text").alias("text"))


@query(
    "x11_extract",
    rf"""
    SELECT c_custkey,
           regexp_extract(raw_phone, '(\d{{2,3}})[-\s]?(\d{{4,5}})[-\s]?(\d{{4,5}})', 0) AS phone,
           regexp_extract(mail, '@([A-Za-z0-9.]+)', 1) AS domain,
           regexp_extract(mail, '^([^@]+)@', 1) AS user_name
    FROM {MESSY_SQL}
    """,
)
def extract(spark, sf_dir):
    return messy_customers(spark, sf_dir).select(
        "c_custkey",
        F.regexp_extract("raw_phone", text.PHONE, 0).alias("phone"),
        F.regexp_extract("mail", text.MAIL_DOMAIN, 1).alias("domain"),
        F.regexp_extract("mail", text.MAIL_USER, 1).alias("user_name"),
    )


@query(
    "x12_pad",
    """
    SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 9, '0') AS padded,
           rpad(o_orderpriority, 8, '.') AS filled FROM orders
    """,
)
def pad(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.padded("o_orderkey", 9).alias("padded"),
        F.rpad("o_orderpriority", 8, ".").alias("filled"),
    )


@query(
    "x13_sentence",
    "SELECT event_id, 'User ' || user_id || ' did ' || event_type || ' with ' || props AS line FROM events",
)
def sentence(spark, sf_dir):
    line = F.format_string("User %d did %s with %s", "user_id", "event_type", "props")
    return table(spark, sf_dir, "events").select("event_id", line.alias("line"))

"""Queries over files with malformed records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.values import tolerant_cast
from tablework.plans.registry import query, table
from tablework.sources import badrecords
from tablework.sources.files import read_or_empty
from tablework.sinks.files import write_csv
from tablework.workspace import new_path

SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"
BAD = "event_type = 'error' AND value < 5"


def _event_lines(spark, sf_dir, broken: bool) -> str:
    """Events as comma-separated lines; in the broken copy small errors lost their fields."""
    events = table(spark, sf_dir, "events")
    line = F.concat_ws(",", "event_id", "user_id", "event_type", "value")
    if broken:
        lost = F.concat(F.lit("BAD"), F.col("event_id").cast("string"), F.lit(","), "event_type")
        line = F.when(F.expr(BAD), lost).otherwise(line)
    path = new_path(spark, "event-lines")
    events.select(line.alias("value")).write.text(path)
    return path


@query(
    "b1_permissive",
    f"""
    SELECT CASE WHEN NOT ({BAD}) THEN event_id END AS event_id,
           CASE WHEN NOT ({BAD}) THEN user_id END AS user_id,
           CASE WHEN NOT ({BAD}) THEN event_type END AS event_type,
           CASE WHEN NOT ({BAD}) THEN value END AS value,
           CASE WHEN {BAD} THEN 'BAD' || event_id || ',' || event_type END AS _corrupt_record
    FROM events
    """,
)
def permissive(spark, sf_dir):
    path = _event_lines(spark, sf_dir, broken=True)
    return badrecords.read_permissive(spark, path, SCHEMA, header=False)


@query(
    "b2_drop_malformed",
    f"SELECT count(*) AS n_rows, max(event_id) AS last_id FROM events WHERE NOT ({BAD})",
)
def drop_malformed(spark, sf_dir):
    path = _event_lines(spark, sf_dir, broken=True)
    rows = badrecords.read_dropping(spark, path, SCHEMA, header=False)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("last_id"))


@query(
    "b3_fail_fast_gate",
    f"""
    SELECT 'clean' AS file, 'accepted' AS verdict, count(*) AS n_rows FROM events
    UNION ALL
    SELECT 'broken', CASE WHEN count(*) FILTER (WHERE {BAD}) > 0 THEN 'rejected' ELSE 'accepted' END,
           CASE WHEN count(*) FILTER (WHERE {BAD}) = 0 THEN count(*) END FROM events
    """,
)
def fail_fast_gate(spark, sf_dir):
    verdicts = [
        (name, *badrecords.gate(spark, _event_lines(spark, sf_dir, broken), SCHEMA, header=False))
        for name, broken in (("clean", False), ("broken", True))
    ]
    return spark.createDataFrame(verdicts, "file string, verdict string, n_rows bigint")


@query(
    "b4_quarantine",
    f"""
    SELECT 'good' AS side, event_id, event_type, NULL AS line FROM events WHERE NOT ({BAD})
    UNION ALL
    SELECT 'bad', NULL, NULL, 'BAD' || event_id || ',' || event_type FROM events WHERE {BAD}
    """,
)
def quarantine(spark, sf_dir):
    path = _event_lines(spark, sf_dir, broken=True)
    parsed = badrecords.read_permissive(spark, path, SCHEMA, header=False)
    good, bad = badrecords.quarantine(parsed, new_path(spark, "quarantine"))
    good = good.select(F.lit("good").alias("side"), "event_id", "event_type")
    bad = bad.select(F.lit("bad").alias("side"), F.col(badrecords.CORRUPT).alias("line"))
    return good.unionByName(bad, allowMissingColumns=True)


@query("b5_read_or_empty", "SELECT event_id, user_id, value FROM events")
def read_or_empty_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    path = new_path(spark, "events-csv")
    write_csv(events, path)
    found = read_or_empty(spark, path, events.schema)
    missing = read_or_empty(spark, new_path(spark, "nothing-here"), events.schema)
    return found.unionByName(missing)


@query(
    "b6_typed_repair",
    f"SELECT event_id, user_id, event_type, value FROM events WHERE NOT ({BAD})",
)
def typed_repair(spark, sf_dir):
    """Everything read as text, short records dropped, the rest given its types."""
    path = _event_lines(spark, sf_dir, broken=True)
    text = "event_id string, user_id string, event_type string, value string"
    rows = badrecords.read_dropping(spark, path, text, header=False)
    return rows.withColumns(
        {
            "event_id": tolerant_cast("event_id", "bigint"),
            "user_id": tolerant_cast("user_id", "bigint"),
            "value": tolerant_cast("value", "double"),
        }
    )

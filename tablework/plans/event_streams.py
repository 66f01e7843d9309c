"""Queries over streams by event time, each run three times and once more on one checkpoint.

Events land in three waves by time, some of them a wave late. What the streams give must equal what
one pass over all rows gives, as far as the last watermark reaches.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tablework.operators.sessions import with_sessions
from tablework.plans.registry import query, table
from tablework.plans.streams import ALL_EVENTS
from tablework.streaming import event_time
from tablework.streaming.incremental import append_available, new_files
from tablework.workspace import new_path

DELAY = timedelta(days=2)
#: Signups are reported a wave late, most of them behind the watermark.
LATE_SIGNUPS = "event_type = 'signup'"
#: Errors of a wave's last day come with the next wave, which the delay allows for.
DISORDER = "event_type = 'error' AND (day(ts) = 10 OR day(ts) = 20)"
WAVE = "CASE WHEN ts < TIMESTAMP{0} '2024-01-11' THEN 0 WHEN ts < TIMESTAMP{0} '2024-01-21' THEN 1 ELSE 2 END"


def arrival(delayed: str, zone: str = "_NTZ") -> str:
    """SQL for the wave a row lands in."""
    return f"least(2, {WAVE.format(zone)} + CASE WHEN {delayed} THEN 1 ELSE 0 END)"


def landed(spark, sf_dir, delayed: str, run, *, repeats: str | None = None, kinds=()):
    """Land the waves one after the other and call ``run(folders)`` after each and once more.

    Without ``kinds`` all events go to one folder, with them those of each type to their own.
    ``repeats`` marks rows that come a second time, a wave later.
    """
    events = table(spark, sf_dir, "events")
    folders = [new_path(spark, "landing") for _ in kinds or (None,)]
    for wave in (0, 1, 2, None):
        if wave is not None:
            rows = events.where(f"{arrival(delayed)} = {wave}")
            if repeats and wave:
                again = events.where(f"({repeats}) AND {arrival(delayed)} = {wave - 1}")
                rows = rows.unionByName(again)
            for folder, kind in zip(folders, kinds or (None,)):
                part = rows if kind is None else rows.where(F.col("event_type") == kind)
                part.write.mode("append").parquet(folder)
        run(folders)
    return events.schema


ON_TIME_SQL = f"""
WITH arrived AS (SELECT *, {arrival(LATE_SIGNUPS, '')} AS wave FROM events),
marks AS (
    SELECT w.wave, (SELECT max(ts) FROM arrived a WHERE a.wave < w.wave) - INTERVAL 2 DAY AS mark
    FROM (SELECT DISTINCT wave FROM arrived) w),
judged AS (SELECT a.*, coalesce(a.ts < m.mark, false) AS late FROM arrived a JOIN marks m USING (wave)),
final AS (SELECT max(ts) - INTERVAL 2 DAY AS mark FROM events)
"""


def _windows(spark, sf_dir, slide):
    """Split each wave's rows, then go on with what is in time; returns the closed windows."""
    aside, sink = new_path(spark, "split"), new_path(spark, "windows")
    marks, progress = new_path(spark, "progress"), new_path(spark, "progress")
    schema = table(spark, sf_dir, "events").schema

    def run(folders):
        event_time.split_late(new_files(spark, folders[0], schema), "ts", DELAY, aside, marks)
        windows = event_time.event_windows(
            event_time.on_time(spark, aside, schema), "ts", DELAY, timedelta(hours=6),
            [F.count("*").alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")],
            slide=slide, keys=["event_type"],
        )
        append_available(windows, sink, progress)

    landed(spark, sf_dir, LATE_SIGNUPS, run)
    return spark.read.parquet(sink).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "event_type", "n_events", F.col("total").cast("decimal(38,2)").alias("total"),
    )


@query(
    "stream_tumbling_windows",
    ON_TIME_SQL
    + """
    SELECT window_start, event_type, count(*) AS n_events,
           sum(CAST(value AS DECIMAL(18, 2))) AS total
    FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS window_start FROM judged WHERE NOT late)
    WHERE window_start + INTERVAL 6 HOUR <= (SELECT mark FROM final)
    GROUP BY window_start, event_type
    """,
)
def tumbling_windows(spark, sf_dir):
    return _windows(spark, sf_dir, None)


@query(
    "stream_sliding_windows",
    ON_TIME_SQL
    + """
    SELECT window_start, event_type, count(*) AS n_events,
           sum(CAST(value AS DECIMAL(18, 2))) AS total
    FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, ts) - to_hours(2 * k) AS window_start
          FROM judged, (SELECT unnest([0, 1, 2]) AS k) WHERE NOT late)
    WHERE window_start + INTERVAL 6 HOUR <= (SELECT mark FROM final)
    GROUP BY window_start, event_type
    """,
)
def sliding_windows(spark, sf_dir):
    return _windows(spark, sf_dir, timedelta(hours=2))


@query(
    "stream_late_rows",
    ON_TIME_SQL + "SELECT event_id, ts, user_id, event_type, value, props, wave FROM judged WHERE late",
)
def late_rows(spark, sf_dir):
    """Rows behind the watermark, with the run that brought them."""
    aside, marks = new_path(spark, "split"), new_path(spark, "progress")
    schema = table(spark, sf_dir, "events").schema

    def run(folders):
        event_time.split_late(new_files(spark, folders[0], schema), "ts", DELAY, aside, marks)

    landed(spark, sf_dir, LATE_SIGNUPS, run)
    return event_time.late_rows(spark, aside, schema).withColumnRenamed("batch", "wave")


SESSIONS_SQL = """
WITH marked AS (
    SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 6 HOUR, true) AS begins FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
    SELECT *, sum(begins::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
    FROM marked)
"""


@query(
    "stream_sessions",
    SESSIONS_SQL
    + """
    SELECT user_id, min(ts) AS session_start, count(*) AS n_events,
           sum(CAST(value AS DECIMAL(18, 2))) AS total
    FROM numbered GROUP BY user_id, session_no
    HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)
    """,
)
def stream_sessions(spark, sf_dir):
    """Sessions that the watermark has closed."""
    sink, progress = new_path(spark, "sessions"), new_path(spark, "progress")
    schema = table(spark, sf_dir, "events").schema

    def run(folders):
        sessions = event_time.event_sessions(
            new_files(spark, folders[0], schema), "ts", DELAY, timedelta(hours=6), ["user_id"],
            [F.count("*").alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")],
        )
        append_available(sessions, sink, progress)

    landed(spark, sf_dir, DISORDER, run)
    return spark.read.parquet(sink).select(
        "user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        "n_events", F.col("total").cast("decimal(38,2)").alias("total"),
    )


@query(
    "batch_sessions",
    SESSIONS_SQL
    + """
    SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS session_start, max(ts) AS session_last,
           count(*) AS n_events
    FROM numbered GROUP BY user_id, session_no
    """,
)
def batch_sessions(spark, sf_dir):
    """All sessions in one pass, those of a busy user cut into chunks and put together."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    numbered = with_sessions(events, ["user_id"], "ts", F.expr("INTERVAL 6 HOURS"), tie=["event_id"])
    return numbered.groupBy("user_id", "session_no").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_last"),
        F.count("*").alias("n_events"),
    )


@query("stream_first_of_key", ALL_EVENTS)
def first_of_key(spark, sf_dir):
    """Purchases and errors of a wave's last day come twice, in two waves; each event stays once."""
    sink, progress = new_path(spark, "first"), new_path(spark, "progress")
    schema = table(spark, sf_dir, "events").schema

    def run(folders):
        stream = new_files(spark, folders[0], schema)
        once = event_time.first_of_key(stream, ["event_id"], "ts", DELAY)
        append_available(once, sink, progress)

    repeats = "event_type IN ('purchase', 'error') AND (day(ts) = 10 OR day(ts) = 20)"
    landed(spark, sf_dir, "false", run, repeats=repeats)
    return spark.read.parquet(sink).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_ordered_visits",
    SESSIONS_SQL
    + """
    , steps AS (
    SELECT *, coalesce(event_type <> lag(event_type) OVER (
        PARTITION BY user_id, session_no ORDER BY ts, event_id), true) AS changes
    FROM numbered)
    SELECT user_id, min(ts) AS visit_start, max(ts) AS visit_last, count(*) AS n_rows,
           string_agg(event_type, '>' ORDER BY ts, event_id) FILTER (changes) AS path
    FROM steps GROUP BY user_id, session_no
    HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)
    """,
)
def ordered_visits(spark, sf_dir):
    """What users did in each visit, in order, though some rows come a wave later."""
    sink, progress = new_path(spark, "visits"), new_path(spark, "progress")
    schema = table(spark, sf_dir, "events").schema

    def run(folders):
        visits = event_time.ordered_visits(
            new_files(spark, folders[0], schema), "user_id", "ts", "event_id", "event_type",
            DELAY, timedelta(hours=6),
        )
        append_available(visits, sink, progress)

    landed(spark, sf_dir, DISORDER, run)
    times = {name: F.col(name).cast("timestamp_ntz") for name in ("visit_start", "visit_last")}
    return spark.read.parquet(sink).withColumns(times)


@query(
    "stream_stream_join",
    """
    WITH v AS (SELECT user_id, event_id AS view_id, ts AS view_at FROM events WHERE event_type = 'view'),
         b AS (SELECT user_id, event_id AS buy_id, ts AS buy_at FROM events WHERE event_type = 'purchase'),
         met AS (SELECT view_id, view_at, user_id, buy_id, buy_at FROM v LEFT JOIN b USING (user_id)
                 WHERE buy_at BETWEEN view_at AND view_at + INTERVAL 3 HOUR)
    SELECT view_id, view_at, user_id, buy_id, buy_at FROM met
    UNION ALL
    SELECT view_id, view_at, user_id, NULL, NULL FROM v
    WHERE view_id NOT IN (SELECT view_id FROM met)
      AND view_at + INTERVAL 3 HOUR < (SELECT least(max(view_at), max(buy_at)) FROM v, b) - INTERVAL 2 DAY
    """,
)
def stream_stream_join(spark, sf_dir):
    """Views with the user's purchases up to three hours later, or alone once none can come."""
    sink, progress = new_path(spark, "met"), new_path(spark, "progress")
    schema = table(spark, sf_dir, "events").schema

    def of(folder, prefix):
        return new_files(spark, folder, schema).select(
            F.col("user_id").alias(f"{prefix}_user"),
            F.col("event_id").alias(f"{prefix}_id"),
            F.col("ts").alias(f"{prefix}_at"),
        )

    def run(folders):
        met = event_time.interval_stream_join(
            of(folders[0], "view"), of(folders[1], "buy"), [("view_user", "buy_user")],
            "view_at", "buy_at", timedelta(hours=3), DELAY, "leftOuter",
        )
        append_available(met, sink, progress)

    landed(spark, sf_dir, "false", run, kinds=("view", "purchase"))
    return spark.read.parquet(sink).select(
        "view_id", F.col("view_at").cast("timestamp_ntz").alias("view_at"),
        F.col("view_user").alias("user_id"), "buy_id",
        F.col("buy_at").cast("timestamp_ntz").alias("buy_at"),
    )

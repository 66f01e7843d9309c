"""Queries that load files as they arrive.

The events land in a folder in three waves by time; streams read the folder.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tablework.plans.registry import query, table
from tablework.streaming import incremental
from tablework.versions.changes import read_changes, snapshot, write_version
from tablework.workspace import new_path

WAVES = [
    "ts < TIMESTAMP_NTZ'2024-01-11'",
    "ts >= TIMESTAMP_NTZ'2024-01-11' AND ts < TIMESTAMP_NTZ'2024-01-21'",
    "ts >= TIMESTAMP_NTZ'2024-01-21'",
]
ALL_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _land(events, folder: str, *waves: int) -> None:
    """Files for the given waves appear in the landing folder."""
    for wave in waves:
        events.filter(WAVES[wave]).write.mode("append").parquet(folder)


@query("t1_new_files", ALL_EVENTS)
def new_files(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    folder, sink = new_path(spark, "landing"), new_path(spark, "loaded")
    _land(events, folder, 0, 1, 2)
    stream = incremental.new_files(spark, folder, events.schema)
    incremental.append_available(stream, sink, new_path(spark, "progress"))
    return spark.read.schema(events.schema).parquet(sink)


@query(
    "t2_only_new_files",
    """
    SELECT 1 AS run, count(*) AS n_rows FROM events WHERE ts < TIMESTAMP '2024-01-11'
    UNION ALL SELECT 2, count(*) FROM events WHERE ts < TIMESTAMP '2024-01-11'
    UNION ALL SELECT 3, count(*) FROM events
    """,
)
def only_new_files(spark, sf_dir):
    """Rows loaded after three runs; nothing new has landed before the second one."""
    events = table(spark, sf_dir, "events")
    folder, sink = new_path(spark, "landing"), new_path(spark, "loaded")
    progress = new_path(spark, "progress")
    results = []
    for run, waves in enumerate([(0,), (), (1, 2)], 1):
        _land(events, folder, *waves)
        stream = incremental.new_files(spark, folder, events.schema)
        incremental.append_available(stream, sink, progress)
        results.append((run, spark.read.parquet(sink).count()))
    return spark.createDataFrame(results, "run int, n_rows bigint")


@query(
    "t3_stored_schema",
    """
    SELECT 'first wave' AS step, 'loaded' AS outcome, count(*) AS n_rows FROM events WHERE ts < TIMESTAMP '2024-01-11'
    UNION ALL SELECT 'second wave', 'loaded', count(*) FROM events WHERE ts < TIMESTAMP '2024-01-21'
    UNION ALL SELECT 'extra column', 'refused', count(*) FROM events WHERE ts < TIMESTAMP '2024-01-21'
    """,
)
def stored_schema(spark, sf_dir):
    """The schema is stored once; files with another one are noticed before they are loaded."""
    events = table(spark, sf_dir, "events")
    folder, sink = new_path(spark, "landing"), new_path(spark, "loaded")
    progress, stored = new_path(spark, "progress"), new_path(spark, "schema")
    incremental.save_schema(spark, events.schema, stored)
    widened = events.withColumn("note", F.lit("new"))
    results = []
    checked = None
    steps = [("first wave", events, 0), ("second wave", events, 1), ("extra column", widened, 2)]
    for step, rows, wave in steps:
        _land(rows, folder, wave)
        schema = incremental.load_schema(spark, stored)
        started = datetime.now(timezone.utc)
        try:
            incremental.refuse_drift(spark, folder, schema, checked)
            # Times of files are rounded in some storages: the next check begins a little earlier.
            checked = (started - timedelta(seconds=5)).strftime("%Y-%m-%dT%H:%M:%S")
            stream = incremental.new_files(spark, folder, schema)
            incremental.append_available(stream, sink, progress)
            outcome = "loaded"
        except ValueError:
            outcome = "refused"
        results.append((step, outcome, spark.read.parquet(sink).count()))
    return spark.createDataFrame(results, "step string, outcome string, n_rows bigint")


@query("t4_exactly_once", ALL_EVENTS)
def exactly_once(spark, sf_dir):
    """Restarts on one checkpoint load every file once."""
    events = table(spark, sf_dir, "events")
    folder, sink = new_path(spark, "landing"), new_path(spark, "loaded")
    progress = new_path(spark, "progress")
    for wave in range(3):
        _land(events, folder, wave)
        stream = incremental.new_files(spark, folder, events.schema)
        incremental.append_available(stream, sink, progress)
    return spark.read.schema(events.schema).parquet(sink)


@query("t5_polling", ALL_EVENTS)
def polling(spark, sf_dir):
    """A running stream that looks for new files every half second."""
    events = table(spark, sf_dir, "events")
    folder, sink = new_path(spark, "landing"), new_path(spark, "loaded")
    _land(events, folder, 0)
    stream = incremental.new_files(spark, folder, events.schema)
    running = incremental.start_append(stream, sink, new_path(spark, "progress"), "500 milliseconds")
    try:
        running.processAllAvailable()
        _land(events, folder, 1, 2)
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(events.schema).parquet(sink)


@query("t6_stream_to_versions", ALL_EVENTS)
def stream_to_versions(spark, sf_dir):
    """Batches become versions of a table that has some; restarts add what is new.

    A stream with a new checkpoint loads all files again as further versions; the snapshot
    holds every event once.
    """
    events = table(spark, sf_dir, "events")
    folder, path = new_path(spark, "landing"), new_path(spark, "event-versions")
    progress, at, key = new_path(spark, "progress"), datetime(2024, 2, 1), ["event_id"]
    write_version(events.filter(WAVES[0]), path, 1, "I", at, key)
    for waves, checkpoint in [((1,), progress), ((2,), progress), ((), progress), ((), f"{progress}-new")]:
        _land(events, folder, *waves)
        stream = incremental.new_files(spark, folder, events.schema)
        incremental.append_versions(stream, path, checkpoint, at, key)
    return snapshot(read_changes(spark, path), key)

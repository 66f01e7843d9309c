"""Streams by event time on small tables: restarts, late rows, state that goes, order."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablework.operators.sessions import with_sessions
from tablework.streaming import event_time
from tablework.streaming.incremental import append_available, new_files, start_append
from tablework.workspace import new_path

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
SCHEMA = "id long, k long, ts timestamp_ntz, kind string"


def at(hours):
    return None if hours is None else START + hours * HOUR


@pytest.fixture
def places(spark):
    return {name: new_path(spark, name) for name in ("landing", "aside", "marks", "sink", "progress")}


def land(spark, folder, rows):
    frame = spark.createDataFrame([(i, k, at(t), kind) for i, k, t, kind in rows], SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(folder)
    return frame.schema


def lose_commit(checkpoint, number):
    commits = Path(checkpoint.removeprefix("file:")) / "commits"
    for commit in [*commits.glob(f"{number}"), *commits.glob(f".{number}.crc")]:
        commit.rename(commit.with_name(f"lost-{commit.name}"))


def test_late_rows_are_split_alike_after_a_failure(spark, places):
    waves = [[(1, 1, 0, "a"), (2, 1, 50, "a")], [(3, 1, 39, "a"), (4, 1, 40, "a"), (5, 1, None, "a")]]

    def run():
        stream = new_files(spark, places["landing"], schema)
        event_time.split_late(stream, "ts", 10 * HOUR, places["aside"], places["marks"])

    for wave in waves:
        schema = land(spark, places["landing"], wave)
        run()

    def late():
        rows = event_time.late_rows(spark, places["aside"], schema).select("id", "batch").collect()
        return sorted(tuple(row) for row in rows)

    assert late() == [(3, 1), (5, 1)]
    lose_commit(places["marks"], 1)
    run()
    assert late() == [(3, 1), (5, 1)]
    read = event_time.on_time(spark, places["aside"], schema)
    append_available(read, places["sink"], places["progress"])
    append_available(read, places["sink"], places["progress"])
    assert sorted(row.id for row in spark.read.parquet(places["sink"]).collect()) == [1, 2, 4]
    assert event_time.late_rows(spark, new_path(spark, "nothing"), schema).count() == 0


def visits_by_hand(rows, idle, last_mark):
    groups = {}
    for i, k, t, kind in rows:
        if k is not None and t is not None:
            groups.setdefault(k, []).append((t, i, kind))
    for k, steps in groups.items():
        visits = []
        for t, _, kind in sorted(steps):
            if not visits or t - visits[-1][1] >= idle:
                visits.append([t, t, 0, []])
            visits[-1][1], visits[-1][2] = t, visits[-1][2] + 1
            visits[-1][3] += [kind] if visits[-1][3][-1:] != [kind] else []
        for first, last, n, path in visits:
            if last + idle <= last_mark:
                yield k, at(first), at(last), n, ">".join(path)


def test_visits_are_in_order_though_rows_are_not(spark, places):
    dice = random.Random(31)
    rows = [(i, dice.choice([1, 1, 1, 2, 3, 4, None]), i / 4, dice.choice("ab")) for i in range(400)]
    rows += [(1000, 9, 0.5, "a"), (1001, 1, None, "b")]
    waves = {}
    for row in rows:
        when = (row[2] or 0) + dice.choice([0, 0, 0, 4])  # up to four hours late
        waves.setdefault(int(when // 13), []).append(row)
    for wave in sorted(waves):
        schema = land(spark, places["landing"], waves[wave])
        visits = event_time.ordered_visits(
            new_files(spark, places["landing"], schema), "k", "ts", "id", "kind", 18 * HOUR, 2 * HOUR
        )
        append_available(visits, places["sink"], places["progress"])
    found = spark.read.parquet(places["sink"]).select(
        "k", F.col("visit_start").cast("timestamp_ntz"), F.col("visit_last").cast("timestamp_ntz"), "n_rows", "path"
    )
    expected = sorted(visits_by_hand(rows, 2, 399 / 4 - 18))
    assert len(expected) > 20
    assert sorted(tuple(row) for row in found.collect()) == expected


def test_visits_are_built_without_python(spark, places):
    """A late row is left out, a NULL label counts, and a visit ends at exactly its idle time."""
    waves = [
        [(1, 7, 0, "a"), (2, 7, 1, None), (3, 7, 1, "a"), (4, 7, 3, "b"), (5, 8, 0, None), (6, 9, 20, "z")],
        [(7, 7, 10, "late"), (8, 8, 10.25, "x"), (9, 9, 60, "z")],
    ]
    for wave in waves:
        schema = land(spark, places["landing"], wave)
        visits = event_time.ordered_visits(
            new_files(spark, places["landing"], schema), "k", "ts", "id", "kind", 10 * HOUR, 2 * HOUR
        )
        assert "InPandas" not in visits._jdf.queryExecution().analyzed().toString()
        append_available(visits, places["sink"], places["progress"])
    found = spark.read.parquet(places["sink"]).select("k", "n_rows", "path").collect()
    assert sorted(map(tuple, found), key=str) == [
        (7, 1, "b"), (7, 3, "a>a"), (8, 1, "x"), (8, 1, None), (9, 1, "z")
    ]


def rows_of_state(query):
    query.awaitTermination()
    return [state["numRowsTotal"] for state in query.lastProgress["stateOperators"]]


def test_state_of_joins_and_of_repeated_keys_goes(spark):
    """Ten waves of a day each: what is held is a matter of the delay, not of all rows."""
    left, right, met, first = (new_path(spark, name) for name in ("left", "right", "met", "first"))
    checkpoints = [new_path(spark, "progress") for _ in range(2)]
    held = []
    for day in range(6):
        rows = [(100 * day + i, i % 5, 24 * day + i / 10, "a") for i in range(100)]
        schema = land(spark, left, rows + rows[:3])
        land(spark, right, [(1000 + i, k, t + 0.5, kind) for i, k, t, kind in rows])
        one = new_files(spark, left, schema)
        two = new_files(spark, right, schema).select(
            F.col("id").alias("id2"), F.col("k").alias("k2"), F.col("ts").alias("ts2")
        )
        joined = event_time.interval_stream_join(
            one, two, [("k", "k2")], "ts", "ts2", HOUR, 2 * HOUR, "leftOuter"
        )
        once = event_time.first_of_key(one, ["id"], "ts", 2 * HOUR)
        held.append((
            *rows_of_state(start_append(joined, met, checkpoints[0])),
            *rows_of_state(start_append(once, first, checkpoints[1])),
        ))
    assert all(count < 150 for counts in held for count in counts)
    assert spark.read.parquet(first).count() == 600
    pairs = spark.read.parquet(met).where("id2 IS NOT NULL")
    # A right row comes five tenths of an hour after its left one.
    expected = 6 * sum(0 <= j + 5 - i <= 10 and i % 5 == j % 5 for i in range(100) for j in range(100))
    # Repeated rows on the left meet what they meet again.
    assert pairs.dropDuplicates(["id", "id2"]).count() == expected


@pytest.mark.parametrize("chunks", [None, 9])
def test_batch_sessions_across_chunks(spark, rows_of, chunks):
    dice = random.Random(33)
    rows = []
    for i in range(500):
        t = dice.choice([dice.randrange(0, 900), dice.randrange(300, 330), None])
        rows.append((i, dice.choice([1, 1, 1, 1, 2, None]), t, "x"))
    df = spark.createDataFrame(rows, "id long, k long, t long, kind string").repartition(3)
    found = with_sessions(df, ["k"], "t", F.lit(4), tie=["id"], chunks=chunks)
    expected, groups = [], {}
    for i, k, t, kind in sorted(rows, key=lambda row: (row[2] is None, row[2], row[0])):
        if t is None:
            expected.append((i, k, t, kind, None))
            continue
        number, last = groups.get(k, (0, None))
        number += last is None or t - last >= 4
        groups[k] = number, t
        expected.append((i, k, t, kind, number))
    assert rows_of(found) == sorted(expected, key=str)
    assert with_sessions(df.limit(0), ["k"], "t", F.lit(4)).count() == 0

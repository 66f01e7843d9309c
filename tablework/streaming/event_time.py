"""Streams by event time: late rows, windows, sessions, repeated keys, ordered state and joins.

Every function takes the delay up to which rows may come out of order. What is behind the watermark
(the latest time of earlier batches less the delay) is dropped by Spark without a trace;
``split_late`` puts such rows aside first, so that they are counted and can be loaded again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from tablework.streaming.incremental import new_files


#: How the folders of split rows are named.
PARTS = [StructField("batch", IntegerType()), StructField("late", BooleanType())]


def _text(span: timedelta) -> str:
    return f"{span // timedelta(microseconds=1)} microseconds"


def with_event_time(stream: DataFrame, time_col: str, delay: timedelta) -> DataFrame:
    """The stream with its watermark; a time without zone is taken in the session's zone."""
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(
        time_col, _text(delay)
    )


def split_late(
    stream: DataFrame, time_col: str, delay: timedelta, folder: str, checkpoint: str
) -> None:
    """Write what is available below ``folder``, rows behind the watermark apart, and return.

    Each batch becomes one folder with the parts ``late=false`` and ``late=true``; its latest time is
    noted beside. The watermark of a batch comes from the notes of earlier ones, so a batch that
    runs again after a failure splits alike and replaces its own folder only. A row without time
    is late. Readers take :func:`on_time` and :func:`late_rows` after the return.
    """
    spark = stream.sparkSession

    def split(batch: DataFrame, number: int) -> None:
        time = F.unix_micros(F.col(time_col).cast("timestamp"))
        watermark = None
        if number:
            earlier = spark.read.schema("newest long, batch long").parquet(f"{folder}/newest")
            newest = earlier.where(F.col("batch") < number).agg(F.max("newest")).first()[0]
            if newest is not None:
                watermark = newest - delay // timedelta(microseconds=1)
        late = time.isNull() if watermark is None else F.coalesce(time < watermark, F.lit(True))
        rows = f"{folder}/rows/batch={number}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(rows)
        written = spark.read.schema(batch.schema).parquet(rows)
        written.agg(F.max(time).alias("newest")).write.mode("overwrite").parquet(
            f"{folder}/newest/batch={number}"
        )

    (
        stream.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def on_time(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A stream of the rows that :func:`split_late` found in time."""
    parts = StructType(schema.fields + PARTS)
    return new_files(spark, f"{folder}/rows", parts).where("NOT late").drop("batch", "late")


def late_rows(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows that :func:`split_late` put aside, with the batch that brought them."""
    parts = StructType(schema.fields + PARTS)
    try:
        return spark.read.schema(parts).parquet(f"{folder}/rows").where("late").drop("late")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], StructType(schema.fields + PARTS[:1]))


def event_windows(
    stream: DataFrame,
    time_col: str,
    delay: timedelta,
    size: timedelta,
    aggregates: Sequence[Column],
    *,
    slide: timedelta | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``window_start, window_end``, keys and aggregates per tumbling (or, with ``slide``, sliding)
    window. Written in append mode, a window comes once, when the watermark has passed its end."""
    window = F.window(time_col, _text(size), _text(slide) if slide else None)
    return (
        with_event_time(stream, time_col, delay)
        .groupBy(window.alias("_window"), *keys)
        .agg(*aggregates)
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .drop("_window")
    )


def event_sessions(
    stream: DataFrame,
    time_col: str,
    delay: timedelta,
    gap: timedelta,
    keys: Sequence[str],
    aggregates: Sequence[Column],
) -> DataFrame:
    """Keys, ``session_start``, ``session_end`` (the last time and ``gap``) and aggregates.

    Sessions of a key that grow together are merged in the state store; in append mode a session
    comes once, when the watermark has passed its end.
    """
    return (
        with_event_time(stream, time_col, delay)
        .groupBy(*keys, F.session_window(time_col, _text(gap)).alias("_session"))
        .agg(*aggregates)
        .withColumns({"session_start": F.col("_session.start"), "session_end": F.col("_session.end")})
        .drop("_session")
    )


def first_of_key(stream: DataFrame, keys: Sequence[str], time_col: str, delay: timedelta) -> DataFrame:
    """Rows whose keys have not come before within ``delay``; a key's state goes after that."""
    return with_event_time(stream, time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def interval_stream_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    within: timedelta,
    delay: timedelta,
    how: str = "inner",
) -> DataFrame:
    """Left rows with the right rows of equal keys up to ``within`` after them.

    Both sides have a watermark, and the time condition bounds both states: a left row goes once
    the watermark has passed its time and ``within``, a right row once it has passed its own time.
    With ``how="leftOuter"`` a left row that met nothing comes when it goes. Names must differ.
    """
    a, b = with_event_time(left, left_time, delay), with_event_time(right, right_time, delay)
    latest = F.col(left_time) + F.expr(f"INTERVAL '{within / timedelta(seconds=1):.6f}' SECOND")
    condition = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= latest)
    for one, two in on:
        condition = condition & (F.col(one) == F.col(two))
    return a.join(b, condition, how)


def ordered_visits(
    stream: DataFrame, key: str, time_col: str, tie: str, label: str, delay: timedelta, idle: timedelta
) -> DataFrame:
    """``key, visit_start, visit_last, n_rows, path``: visits with their labels in order of time.

    A visit ends where a key is idle for ``idle`` or longer; ``path`` joins its labels by ``>``, a run
    of equal ones written once, NULL ones left out. Rows wait in the state, by key and time, until the
    watermark has passed them; then they go to the key's visits, which grow together in a second state
    and come once, when the watermark has passed their end, whatever the order the rows came in. Rows of
    one time are in order of ``tie``. Both states are Spark's own aggregates. What waits is bounded by
    the rows within the delay and one idle time.
    """
    rows = (
        with_event_time(stream, time_col, delay)
        .select(
            F.col(key),
            F.col(time_col),
            F.struct(
                F.col(tie).isNull().alias("last"),
                F.col(tie).cast("long").alias("tie"),
                F.col(label).cast("string").alias("label"),
            ).alias("_row"),
        )
        .where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    )
    passed = rows.groupBy(key, time_col).agg(F.collect_list("_row").alias("_rows"))
    # Spark lets a session go on at its very end, where a visit ends.
    session = F.session_window(time_col, _text(idle - timedelta(microseconds=1)))
    visits = passed.groupBy(key, session.alias("_session")).agg(
        F.min(time_col).alias("visit_start"),
        F.max(time_col).alias("visit_last"),
        F.collect_list(F.struct(F.col(time_col).alias("at"), F.array_sort("_rows").alias("rows"))).alias(
            "_steps"
        ),
    )
    labels = F.flatten(
        F.transform(F.array_sort("_steps"), lambda step: F.transform(step["rows"], lambda row: row["label"]))
    )
    same_as_before = lambda name, i: (i > 0) & F.coalesce(
        name == F.get("_labels", i - 1), F.lit(False)
    )
    path = F.filter("_labels", lambda name, i: name.isNotNull() & ~same_as_before(name, i))
    return visits.withColumn("_labels", labels).select(
        key,
        "visit_start",
        "visit_last",
        F.size("_labels").cast("long").alias("n_rows"),
        F.when(F.size(path) > 0, F.array_join(path, ">")).alias("path"),
    )

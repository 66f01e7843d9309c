"""Sessions of entities of any size, in a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.operators.windows import CHUNK, group_window, with_chunks


def with_sessions(
    df: DataFrame,
    entity: Sequence[str],
    time: str,
    gap: Column,
    *,
    tie: Sequence[str] = (),
    out: str = "session_no",
    chunks: int | None = None,
) -> DataFrame:
    """Number the sessions of each entity from 1; a session ends where ``gap`` or more passes.

    Rows without time are no part of a session: their number is NULL. A NULL entity is one entity.
    ``tie`` names columns that, with the time, cut a crowd of equal times.

    Long entities are cut into chunks. A chunk numbers its own sessions, and its first and last time
    decide whether its first one goes on from the chunk before: one row per chunk carries how many
    sessions began earlier. ``gap`` is an interval, or a number where times are numbers.
    """
    timed = df.where(F.col(time).isNotNull())
    order = [time, *tie]
    chunked = with_chunks(timed, entity, order, chunks)
    window = group_window(entity, order)
    begins = (F.col(time) - F.lag(time).over(window)) >= gap
    # The first row of a chunk counts as no beginning here; the chunk's offset decides.
    local = chunked.withColumn("_begins", F.coalesce(begins, F.lit(False)).cast("long")).withColumn(
        "_local", F.sum("_begins").over(window.rowsBetween(Window.unboundedPreceding, 0))
    )
    parts = chunked_parts(local, entity, time)
    in_order = Window.partitionBy(*entity).orderBy(CHUNK)
    apart = (F.col("_first") - F.lag("_last").over(in_order)) >= gap
    parts = parts.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("long"))
    before = F.sum("_begun").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    heads = F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    offsets = parts.select(
        *[F.col(f"`{name}`").alias(f"_of_{i}") for i, name in enumerate(entity)],
        F.col(CHUNK).alias("_of_chunk"),
        (F.coalesce(before, F.lit(0)) + heads).alias("_offset"),
    )
    same = F.col(CHUNK) == F.col("_of_chunk")
    for i, name in enumerate(entity):
        same = same & F.col(f"`{name}`").eqNullSafe(F.col(f"_of_{i}"))
    numbered = local.join(offsets, same).select(
        *df.columns, (F.col("_local") + F.col("_offset")).alias(out)
    )
    untimed = df.where(F.col(time).isNull()).withColumn(out, F.lit(None).cast("long"))
    return numbered.unionByName(untimed)


def chunked_parts(local: DataFrame, entity: Sequence[str], time: str) -> DataFrame:
    """First and last time of each chunk of an entity, and the sessions that begin within it."""
    return local.groupBy(*entity, CHUNK).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), F.sum("_begins").alias("_begun")
    )

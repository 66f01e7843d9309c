"""Window operators for entities of any size.

A window partitioned by an entity alone puts a hot entity in one task. Here the rows are
range-partitioned by entity and order once, which cuts long entities at sampled bounds, and the
number of a row's partition is its chunk. Windows run per entity and chunk, and what a row needs
from other chunks is added exactly: the neighbouring rows for frames, lag and lead, or the counts
of earlier chunks for ranks. The order decides itself where NULL and NaN stand, in any type; it
should end in a unique key, so that a crowded value can be cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.workspace import checkpointed

CHUNK = "_chunk"
EXTRA = "_extra"


def sort_columns(order: Sequence[str]) -> list[Column]:
    """Sort expressions; a name with a leading minus sorts descending."""
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order]


def reverse_order(order: Sequence[str]) -> list[Column]:
    """The exact reverse of ``sort_columns``, NULLs included."""
    return [
        F.asc_nulls_first(name[1:]) if name.startswith("-") else F.desc_nulls_last(name)
        for name in order
    ]


def with_chunks(
    df: DataFrame, entity: Sequence[str], order: Sequence[str], chunks: int | None = None
) -> DataFrame:
    """Add the chunk number; chunks follow the order within an entity.

    ``chunks`` is the number of range partitions, by default Spark's own choice by size. The
    rows are written once, so that all later passes see the same cuts.
    """
    keys = [F.col(name) for name in entity] + sort_columns(order)
    ranged = df.repartitionByRange(*([chunks] if chunks else []), *keys)
    return checkpointed(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def group_window(entity: Sequence[str], order: Sequence[str]):
    """The window per entity and chunk."""
    return Window.partitionBy(*entity, CHUNK).orderBy(*sort_columns(order))


def _with_neighbours(
    chunked: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    carried: Sequence[str],
    before: int,
    after: int,
) -> DataFrame:
    """Add to each chunk the ``before`` rows ahead of it and the ``after`` rows behind it.

    The added rows hold the order and ``carried`` columns only and are marked in EXTRA. Any
    earlier chunk of an entity has at least one row, so ``before`` chunks hold enough of them.
    """
    names = list(dict.fromkeys([*(name.lstrip("-") for name in order), *carried]))
    result = chunked.withColumn(EXTRA, F.lit(False))
    for size, backwards in ((before, True), (after, False)):
        if not size:
            continue
        direction = reverse_order(order) if backwards else sort_columns(order)
        place = F.row_number().over(Window.partitionBy(*entity, CHUNK).orderBy(*direction))
        # The place comes first in the struct and counts up in the window's own order.
        step = F.when(F.lit(backwards), -F.col("_n")).otherwise(F.col("_n"))
        edge = (
            chunked.withColumn("_n", place)
            .where(F.col("_n") <= size)
            .groupBy(*entity, CHUNK)
            .agg(F.array_sort(F.collect_list(F.struct(step.alias("_step"), *names))).alias("_edge"))
        )
        chunk_order = Window.partitionBy(*entity).orderBy(CHUNK)
        nearby = chunk_order.rowsBetween(-size, -1) if backwards else chunk_order.rowsBetween(1, size)
        edges = edge.withColumn("_rows", F.flatten(F.collect_list("_edge").over(nearby)))
        first = F.greatest(F.size("_rows") - size + 1, F.lit(1)) if backwards else F.lit(1)
        wanted = F.explode(F.slice("_rows", first, F.lit(size))).alias("_row")
        added = edges.select(*entity, CHUNK, wanted).select(
            *entity, CHUNK, *[F.col(f"_row.{name}") for name in names], F.lit(True).alias(EXTRA)
        )
        result = result.unionByName(added, allowMissingColumns=True)
    return result


def with_neighbour_columns(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    columns: dict[str, Column],
    *,
    carried: Sequence[str],
    before: int = 0,
    after: int = 0,
    chunks: int | None = None,
) -> DataFrame:
    """Add window ``columns`` that look at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` maps names to expressions over ``group_window(entity, order)``; ``carried`` are
    the columns these expressions read. ``order`` is a total order within an entity.
    """
    chunked = with_chunks(df, entity, order, chunks)
    padded = _with_neighbours(chunked, entity, order, carried, before, after)
    result = padded.withColumns(columns).filter(~F.col(EXTRA))
    return result.select(*df.columns, *columns)


def rolling_mean(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    value: str,
    width: int,
    out: str = "rolling_mean",
    chunks: int | None = None,
) -> DataFrame:
    """Mean of ``value`` over the row and the ``width - 1`` rows before it, per entity.

    NULL until ``width`` values have been seen, and where the frame holds a NULL.
    """
    frame = group_window(entity, order).rowsBetween(-(width - 1), 0)
    total = F.sum(value).over(frame).cast("double")
    mean = F.when(F.count(value).over(frame) == width, total / F.lit(width))
    return with_neighbour_columns(
        df, entity, order, {out: mean}, carried=[value], before=width - 1, chunks=chunks
    )


def lag_lead(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    value: str,
    distance: int = 1,
    chunks: int | None = None,
) -> DataFrame:
    """Add ``previous`` and ``following``: ``value`` of the rows ``distance`` away, per entity."""
    window = group_window(entity, order)
    columns = {
        "previous": F.lag(value, distance).over(window),
        "following": F.lead(value, distance).over(window),
    }
    return with_neighbour_columns(
        df,
        entity,
        order,
        columns,
        carried=[value],
        before=distance,
        after=distance,
        chunks=chunks,
    )


def ranked(
    df: DataFrame, entity: Sequence[str], value: str, tie: str, chunks: int | None = None
) -> DataFrame:
    """Add ``row_no``, ``rank_no`` and ``dense_no`` by descending ``value`` within the entity.

    ``tie`` makes the row numbers unique. Ranks are taken per chunk and raised by the rows and
    distinct values of the chunks before it; rows whose value begins in an earlier chunk get the
    rank of the place where it begins.
    """
    order = [f"-{value}", tie]
    chunked = with_chunks(df, entity, order, chunks)
    by_value = Window.partitionBy(*entity, CHUNK).orderBy(F.desc(value))
    local = chunked.withColumns(
        {
            "_row": F.row_number().over(group_window(entity, order)),
            "_rank": F.rank().over(by_value),
            "_dense": F.dense_rank().over(by_value),
        }
    )
    sizes = local.groupBy(*entity, CHUNK).agg(
        F.max("_row").alias("_rows"),
        F.max("_rank").alias("_last_rank"),
        F.max("_dense").alias("_values"),
        F.min_by(value, "_row").alias("_first"),
        F.max_by(value, "_row").alias("_last"),
    )
    in_order = Window.partitionBy(*entity).orderBy(CHUNK)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.lag(CHUNK).over(in_order).isNotNull() & F.col("_first").eqNullSafe(
        F.lag("_last").over(in_order)
    )
    sizes = sizes.withColumns(
        {
            "_goes_on": goes_on,
            "_rows_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
        }
    ).withColumns(
        {
            "_new_values": F.col("_values") - F.col("_goes_on").cast("int"),
            # Where the chunk's last value begins, unless it has gone on for the whole chunk.
            "_begin": F.when(
                ~(F.col("_goes_on") & (F.col("_values") == 1)),
                F.col("_rows_before") + F.col("_last_rank"),
            ),
        }
    )
    offsets = sizes.select(
        *[F.col(name).alias(f"_of_{i}") for i, name in enumerate(entity)],
        F.col(CHUNK).alias("_of_chunk"),
        "_goes_on",
        "_rows_before",
        (F.coalesce(F.sum("_new_values").over(earlier), F.lit(0)) - F.col("_goes_on").cast("int"))
        .alias("_values_before"),
        F.last("_begin", ignorenulls=True).over(earlier).alias("_began"),
    )
    same = F.col(CHUNK) == F.col("_of_chunk")
    for i, name in enumerate(entity):
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{i}"))
    in_first = F.col("_goes_on") & (F.col("_dense") == 1)
    return local.join(offsets, same).select(
        *df.columns,
        (F.col("_row") + F.col("_rows_before")).alias("row_no"),
        F.when(in_first, F.col("_began"))
        .otherwise(F.col("_rank") + F.col("_rows_before"))
        .alias("rank_no"),
        (F.col("_dense") + F.col("_values_before")).alias("dense_no"),
    )

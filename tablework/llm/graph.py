"""Connected components of links that stay in Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.workspace import checkpointed


def _signature(links: DataFrame) -> tuple:
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def component_roots(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b longs) that is not its component's root.

    The root is the smallest node. Links are rewired to ever smaller neighbours, first those to
    larger nodes, then those to smaller ones, until each component is a star; the number of
    rounds grows with the logarithm of the longest chain. Every round is written, so a lost
    executor costs one round at most. Minima combine before the shuffle, and the written minima
    are joined back, where Spark splits a node of many links at run time.
    """
    links = checkpointed(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    signature = _signature(links)
    while signature[0]:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = checkpointed(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("least"))
            .select("node", F.least("node", "least").alias("least")),
            "large-star",
        )
        upward = (
            both.where("b > a")
            .join(smallest, F.col("a") == F.col("node"))
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        upward = checkpointed(upward, "upward")
        smallest = checkpointed(
            upward.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "small-star"
        )
        rewired = (
            upward.join(smallest, F.col("a") == F.col("node"))
            .where("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionAll(smallest.select(F.col("node").alias("a"), F.col("least").alias("b")))
            .distinct()
        )
        links = checkpointed(rewired, "links")
        before, signature = signature, _signature(links)
        if signature == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))

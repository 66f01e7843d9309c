"""Recursive queries over links, by rounds whose frontier is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.workspace import checkpointed


def reachable(links: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``node, depth``: the nodes that ``links`` (source, target) reach from ``roots`` (node).

    ``depth`` is the least number of links, 0 for the roots. Each round follows the links of the
    nodes found last and takes what no round has found before, so cycles end; it stops when nothing
    is new or at ``max_depth``. The links are written once, whatever made them, and so is every frontier:
    a lost executor costs one round at most, and plans don't grow with the depth. Equal targets combine
    before the shuffle. NULL nodes are left out.
    """
    links = checkpointed(links.select("source", "target").dropna().distinct(), "links")
    frontier = checkpointed(roots.select("node").dropna().distinct(), "frontier")
    found = [frontier.withColumn("depth", F.lit(0))]
    while (max_depth is None or len(found) <= max_depth) and not frontier.isEmpty():
        seen = found[0].select("node")
        for earlier in found[1:]:
            seen = seen.unionAll(earlier.select("node"))
        stepped = (
            links.join(frontier, F.col("source") == F.col("node"), "left_semi")
            .select(F.col("target").alias("node"))
            .distinct()
            .join(seen, "node", "left_anti")
        )
        frontier = checkpointed(stepped, "frontier")
        found.append(frontier.withColumn("depth", F.lit(len(found))))
    result = found[0]
    for frontier in found[1:]:
        result = result.unionAll(frontier)
    return result


def paths(links: DataFrame, roots: DataFrame, max_depth: int) -> DataFrame:
    """``root, node, depth, path, is_cycle``: every walk along ``links`` (source, target) from each of
    ``roots`` (node), up to ``max_depth`` links.

    ``path`` lists the nodes from the root on. A walk ends where it comes to a node it has met, and
    this last step is marked. Repeated links are one. Unlike ``reachable`` this grows with the number
    of walks, so ``max_depth`` must be given. Every frontier is written.
    """
    links = checkpointed(links.select("source", "target").dropna().distinct(), "links")
    frontier = roots.select(F.col("node").alias("root")).dropna().distinct().select(
        "root", F.col("root").alias("node"), F.lit(0).alias("depth"),
        F.array("root").alias("path"), F.lit(False).alias("is_cycle"),
    )
    frontier = checkpointed(frontier, "walks")
    result = frontier
    for depth in range(1, max_depth + 1):
        open_walks = frontier.where("NOT is_cycle")
        if open_walks.isEmpty():
            break
        stepped = open_walks.join(links, F.col("node") == F.col("source")).select(
            "root",
            F.col("target").alias("node"),
            F.lit(depth).alias("depth"),
            F.array_append("path", F.col("target")).alias("path"),
            F.array_contains("path", F.col("target")).alias("is_cycle"),
        )
        frontier = checkpointed(stepped, "walks")
        result = result.unionAll(frontier)
    return result

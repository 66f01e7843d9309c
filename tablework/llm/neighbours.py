"""Approximate nearest neighbours from balanced posting lists.

Centroids of balanced clusters are fitted on a bounded sample and linked to a graph that fits in
a task's memory. Every vector goes to the list of its nearest centroid, and one near a boundary
to the lists of further centroids too. A query walks the graph, keeps the lists whose centroids
are at most a given ratio farther than the nearest, and computes exact distances in these.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.vectors import ranked, stacked, usable_vectors
from tablework.workspace import checkpointed

#: The bound of the sample the centroids are fitted on, and of their number.
SAMPLE = 20_000
MAX_CENTROIDS = 1024
ROUNDS = 8
#: Weight of a cluster's size against distance while fitting.
BALANCE = 0.15
DEGREE = 16
BEAM = 24
#: A vector is filed under centroids up to this much farther than its nearest, at most so many.
FILE_RATIO = 1.2
COPIES = 8
#: A query reads the lists of centroids up to this much farther than its nearest.
READ_RATIO = 1.2
#: Rows that the lists a query reads are the first lists of, at least, for each wanted row.
READ_ROWS = 32
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(
        (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2.0 * a @ b.T, 0.0
    )


def balanced_centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Centroids by alternating assignment and means; full clusters seem farther away."""
    sample = np.unique(sample, axis=0)  # copies would draw all centroids to one place
    random = np.random.default_rng(7)
    count = min(count, len(sample))
    centroids = sample[random.permutation(len(sample))[:count]]
    sizes = np.full(count, len(sample) / count)
    for _ in range(ROUNDS):
        distances = squared_distances(sample, centroids)
        fullness = sizes / sizes.mean() - 1.0
        nearest = (distances + BALANCE * distances.min(axis=1).mean() * fullness).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=count).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        used = sizes > 0
        centroids[used] = sums[used] / sizes[used, None]
    return centroids


class CentroidGraph:
    """Centroids, each linked to near ones in different directions."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        n = len(centroids)
        distances = squared_distances(centroids, centroids)
        links = []
        for node in range(n):
            chosen: list[int] = []
            for other in np.argsort(distances[node], kind="stable"):
                if other == node:
                    continue
                if all(distances[node, other] < distances[other, c] for c in chosen):
                    chosen.append(int(other))
                if len(chosen) == DEGREE:
                    break
            links.append(chosen)
        for node in range(n):  # both ways, so that a near node is reached from either side
            for other in list(links[node]):
                if node not in links[other]:
                    links[other].append(node)
        self._connect(links, distances)
        self.width = max(map(len, links), default=0)
        self.links = np.full((n, max(1, self.width)), -1)
        for node, chosen in enumerate(links):
            self.links[node, : len(chosen)] = chosen
        self.entry = int(distances.sum(axis=1).argmin())

    @staticmethod
    def _connect(links: list[list[int]], distances: np.ndarray) -> None:
        """Link what the first node doesn't reach to the nearest node that it does."""
        reached, waiting = np.zeros(len(links), bool), [0]
        while True:
            while waiting:
                node = waiting.pop()
                if not reached[node]:
                    reached[node] = True
                    waiting.extend(links[node])
            if reached.all():
                return
            apart = np.where(reached[:, None] & ~reached[None, :], distances, np.inf)
            near, far = np.unravel_index(apart.argmin(), apart.shape)
            links[near].append(int(far))
            links[far].append(int(near))
            waiting.append(int(far))

    def walk(self, vectors: np.ndarray, ratio: float) -> np.ndarray:
        """Distances to the centroids met on the way, infinite for all others.

        From the entry all nodes are followed that are within ``ratio`` of the nearest one or
        among the ``BEAM`` nearest so far, until none is left.
        """
        n, count = len(vectors), len(self.centroids)
        known = np.full((n, count), np.inf)
        followed = np.zeros((n, count), bool)
        known[:, self.entry] = np.sqrt(((vectors - self.centroids[self.entry]) ** 2).sum(axis=1))
        while True:
            limit = known.min(axis=1) * ratio
            if count > BEAM:
                limit = np.maximum(limit, np.partition(known, BEAM - 1, axis=1)[:, BEAM - 1])
                limit = np.where(np.isfinite(limit), limit, np.finfo(float).max)
                open_ = ~followed & (known <= limit[:, None])
            else:
                open_ = ~followed & np.isfinite(known)
            rows, nodes = np.nonzero(open_)
            if not len(rows):
                return known
            followed[rows, nodes] = True
            reached = np.zeros((n, count), bool)
            for step in range(self.width):
                others = self.links[nodes, step]
                there = others >= 0
                reached[rows[there], others[there]] = True
            rows, nodes = np.nonzero(reached & np.isinf(known))
            for lo in range(0, len(rows), 1 << 16):
                r, c = rows[lo : lo + (1 << 16)], nodes[lo : lo + (1 << 16)]
                known[r, c] = np.sqrt(((vectors[r] - self.centroids[c]) ** 2).sum(axis=1))

    def file(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, lists and whether the list is the row's first."""
        known = self.walk(vectors, 1.0)
        take = min(COPIES, known.shape[1])
        order = np.argsort(known, axis=1, kind="stable")[:, :take]
        near = np.take_along_axis(known, order, axis=1)
        fits = near <= near[:, :1] * FILE_RATIO
        rows, place = np.nonzero(fits)
        return rows, order[rows, place], place == 0

    def read(self, vectors: np.ndarray, first_sizes: np.ndarray, least: int):
        """Rows and lists to read; more lists until they are the first of ``least`` rows."""
        known = self.walk(vectors, READ_RATIO)
        order = np.argsort(known, axis=1, kind="stable")
        near = np.take_along_axis(known, order, axis=1)
        before = np.cumsum(first_sizes[order], axis=1) - first_sizes[order]
        fits = (near <= near[:, :1] * READ_RATIO) | (before < least)
        rows, place = np.nonzero(fits)
        return rows, order[rows, place]


def shelves(centroids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The shelf of each list: lists next to each other together hold a block of rows at most.

    The lists are walked from each to its nearest one left; a list longer than a block has a
    shelf of its own.
    """
    distances = squared_distances(centroids, centroids)
    left = np.ones(len(centroids), bool)
    shelf, at, number, filled = np.zeros(len(centroids), int), 0, 0, 0
    for _ in range(len(centroids)):
        if filled and filled + sizes[at] > CANDIDATE_BLOCK:
            number, filled = number + 1, 0
        shelf[at] = number
        filled += sizes[at]
        left[at] = False
        at = int(np.where(left, distances[at], np.inf).argmin())
    return shelf


def blocks_of(vectors: pd.DataFrame, rows_at_once: int = 512):
    for lo in range(0, len(vectors), rows_at_once):
        part = vectors.iloc[lo : lo + rows_at_once]
        yield part, stacked(part["vector"])


def nearest_in_block(ids, lists, candidates, queries, k: int) -> pd.DataFrame:
    """Each query's ``k`` nearest candidates in its lists, ties to the smaller id.

    ``queries`` are (id, vector, lists). A candidate may stand in several lists, at most
    ``COPIES``, and counts once.
    """
    order = np.argsort(lists, kind="stable")
    ids, lists, candidates = ids[order], lists[order], candidates[order]
    parts = []
    for query_id, query, read in queries:
        first, last = np.searchsorted(lists, read), np.searchsorted(lists, read, side="right")
        at = np.concatenate([np.arange(a, b) for a, b in zip(first, last)])
        at = at[ids[at] != query_id]
        if not len(at):
            continue
        distances = np.sqrt(((candidates[at] - query) ** 2).sum(axis=1))
        if len(at) > k * COPIES:
            near = distances <= np.partition(distances, k * COPIES - 1)[k * COPIES - 1]
            at, distances = at[near], distances[near]
        sorted_ = np.lexsort((ids[at], distances))
        found, distances = ids[at][sorted_], distances[sorted_]
        once = np.sort(np.unique(found, return_index=True)[1])[:k]
        parts.append((np.full(len(once), query_id), found[once], distances[once]))
    if not parts:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(FOUND)
    columns = [np.concatenate([part[i] for part in parts]) for i in range(3)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))


FOUND = {"query_id": "int64", "vec_id": "int64", "score": "float64"}


def approximate_neighbours(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by Euclidean distance.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but those with
    the query's id. Vectors that are null, empty or zero or hold null or non-finite components
    take no part, nor do rows without id. Vectors meet vectors of the same length. Of rows that
    share an id the smallest vector counts. Scores are exact; ties go to the smaller id. A query
    reads lists until they hold enough rows, so it gets ``k`` rows if there are as many.

    Every row is filed. The centroids, at most ``MAX_CENTROIDS``, travel with the code. Short
    lists next to each other share a shelf, on which a query finds its nearest rows at once. A
    shelf that is long or much asked for is cut into blocks of candidates and of queries, and
    every pair of blocks is a group of bounded size.
    """
    valid = checkpointed(
        usable_vectors(vectors, id_col, vector_col, nonzero=True), "vectors"
    )
    results = None
    for size, n in sorted(valid.groupBy("size").count().collect()):
        own = valid.where(F.col("size") == size)
        found = _neighbours_of_size(own, n, k, every)
        results = found if results is None else results.unionByName(found)
    if results is None:
        results = valid.select(
            F.col("id").alias("query_id"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        ).where("false")
    return ranked(results, k, F.col("score"))


def _neighbours_of_size(valid: DataFrame, n: int, k: int, every: int) -> DataFrame:
    sample = stacked(
        valid.orderBy(F.xxhash64("id")).limit(SAMPLE).select("vector").toPandas()["vector"]
    )
    count = max(1, min(MAX_CENTROIDS, math.isqrt(4 * n)))
    graph = CentroidGraph(balanced_centroids(sample, count))

    def file(batches):
        for batch in batches:
            for part, values in blocks_of(batch):
                rows, lists, first = graph.file(values)
                filed = part.iloc[rows]
                yield pd.DataFrame(
                    {"id": filed["id"], "vector": filed["vector"], "list": lists, "first": first}
                )

    fields = valid.schema["vector"].dataType.simpleString()
    filed = checkpointed(
        valid.select("id", "vector").mapInPandas(
            file, f"id long, vector {fields}, list int, first boolean"
        ),
        "posting-lists",
    )
    sizes = np.zeros((2, len(graph.centroids)), np.int64)
    counted = filed.groupBy("list").agg(
        F.count("*").alias("n"), F.sum(F.col("first").cast("int")).alias("n_first")
    )
    for row in counted.collect():  # a row per centroid at most
        sizes[:, row["list"]] = row["n"], row["n_first"]
    shelf_of = shelves(graph.centroids, sizes[0])
    lengths = np.bincount(shelf_of, weights=sizes[0])
    place = valid.sparkSession.createDataFrame(
        [
            (number, int(shelf), max(1, math.ceil(lengths[shelf] / CANDIDATE_BLOCK)))
            for number, shelf in enumerate(shelf_of)
        ],
        "list int, shelf int, n_blocks int",
    )

    def read(batches):
        for batch in batches:
            for part, values in blocks_of(batch):
                rows, lists = graph.read(values, sizes[1], READ_ROWS * k + 1)
                stands = shelf_of[lists]
                order = np.lexsort((lists, stands, rows))
                rows, lists, stands = rows[order], lists[order], stands[order]
                new = np.r_[True, (rows[1:] != rows[:-1]) | (stands[1:] != stands[:-1])]
                asked = part.iloc[rows[new]]
                yield pd.DataFrame(
                    {
                        "id": asked["id"],
                        "vector": asked["vector"],
                        "shelf": stands[new],
                        "lists": np.split(lists, np.flatnonzero(new)[1:]),
                    }
                )

    asked = checkpointed(
        valid.where(F.col("id") % every == 0)
        .select("id", "vector")
        .mapInPandas(read, f"id long, vector {fields}, shelf int, lists array<int>"),
        "list-reads",
    )
    shape = F.broadcast(  # a row per centroid at most
        asked.groupBy("shelf")
        .agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("n_query_blocks"))
        .join(place, "shelf")
    )
    shelves_asked = F.broadcast(shape.drop("list").distinct())

    def own_block(number: str, salt: str):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(number)).cast("int")

    def all_blocks(number: str):
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    columns = ["id", "vector", "list", "lists", "shelf", "block", "query_block"]
    candidates = (
        filed.join(shape, "list")
        .withColumns({"lists": F.lit(None).cast("array<int>"), "block": own_block("n_blocks", "c")})
        .withColumn("query_block", all_blocks("n_query_blocks"))
        .select(columns)
    )
    queries = (
        asked.join(shelves_asked, "shelf")
        .withColumns({"list": F.lit(-1), "query_block": own_block("n_query_blocks", "q")})
        .withColumn("block", all_blocks("n_blocks"))
        .select(columns)
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["list"].to_numpy() < 0
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(FOUND)
        values, ids = stacked(group["vector"]), group["id"].to_numpy(np.int64)
        wanted = zip(ids[asks], values[asks], group["lists"].to_numpy()[asks])
        lists = group["list"].to_numpy(np.int64)[~asks]
        return nearest_in_block(ids[~asks], lists, values[~asks], wanted, k)

    return (
        candidates.unionByName(queries)
        .groupBy("shelf", "block", "query_block")
        .applyInPandas(search, "query_id long, vec_id long, score double")
        .dropDuplicates(["query_id", "vec_id"])
    )

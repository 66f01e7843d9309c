"""Exact top-k search by inner product with bounds from segment statistics.

A vector is cut into segments, and of each segment the mean and the deviation are kept. Two
vectors are at least as far apart as their segments' means and deviations are:
``distance^2 >= sum of length * ((mean - mean)^2 + (deviation - deviation)^2)``. As the inner
product is half of ``|x|^2 + |y|^2 - distance^2``, this bounds it from above. The bound is taken
with few segments first and with more for what survives; exact products of the most promising
rows raise the threshold on the way, and only the last survivors are computed in full.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.vectors import ranked, stacked, usable_vectors
from tablework.workspace import checkpointed

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 8192
#: Components a block holds at most on average, so that long vectors make smaller blocks.
BLOCK_COMPONENTS = 1 << 20
#: Queries whose bounds are held at a time within a block.
SLICE = 64
#: Above one pair in so many, one matrix product over a slice costs less than the pairs one by one.
DENSE = 64
#: Rows of this length or more could give products that doubles don't hold exactly; pairs with such
#: a row go without bounds, and their scores are sums of Python's integers. For all others
#: ``sum of |x * y| <= |x| * |y| < 2^52``, so that every partial sum is exact, in any order.
MAX_NORM = 2.0**26


def quantised(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * vectors)


def is_large(vectors: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", vectors, vectors) >= MAX_NORM**2


def large_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows by Python's integers; one beyond a long is an error."""
    return np.array(
        [sum(int(a) * int(b) for a, b in zip(*pair)) for pair in zip(x.tolist(), y.tolist())],
        np.int64,
    )


def segment_counts(size: int) -> list[int]:
    """Segments of the levels: 1, 4, 16, ... as long as a segment has four components."""
    counts = [1]
    while counts[-1] * 16 <= size:
        counts.append(counts[-1] * 4)
    return counts


def segment_statistics(vectors: np.ndarray, count: int) -> np.ndarray:
    """Per row the segments' means and deviations, each times the root of the length.

    The inner product of two such rows is the bound that the squared distances give.
    """
    edges = np.linspace(0, vectors.shape[1], count + 1).astype(int)
    lengths = np.diff(edges).astype(float)
    sums = np.add.reduceat(vectors, edges[:-1], axis=1)
    squares = np.add.reduceat(vectors * vectors, edges[:-1], axis=1)
    means = sums / lengths
    deviations = np.sqrt(np.maximum(squares / lengths - means * means, 0.0))
    return np.hstack([means, deviations]) * np.sqrt(np.r_[lengths, lengths])


class Block:
    """Candidates with their statistics on all levels."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.counts = segment_counts(vectors.shape[1])
        self.levels = [segment_statistics(vectors, count) for count in self.counts]
        self.large = is_large(vectors)
        squares = (vectors * vectors).sum(axis=1)
        self.norm = float(np.sqrt(squares[~self.large].max(initial=0.0)))

    def products(self, queries: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Exact integer inner products of the pairs."""
        exact = np.empty(len(q), np.int64)
        rare = is_large(queries)[q] | self.large[c]
        if rare.any():
            exact[rare] = large_products(queries[q[rare]], self.vectors[c[rare]])
        plain = np.flatnonzero(~rare)
        if len(plain) > len(queries) * len(self.ids) // DENSE:
            exact[plain] = (queries @ self.vectors.T)[q[plain], c[plain]]
            return exact
        for lo in range(0, len(plain), 1 << 17):
            part = plain[lo : lo + (1 << 17)]
            exact[part] = np.einsum("ij,ij->i", queries[q[part]], self.vectors[c[part]])
        return exact

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """Pairs (query, candidate, score) that hold each query's best ``k``.

        ``alive`` marks the pairs whose bound still reaches the query's threshold, the ``k``-th
        exact score found so far.
        """
        n_queries, n = len(queries), len(self.ids)
        threshold = np.full(n_queries, -np.inf)
        slack = 1e-9 * self.norm * np.sqrt((queries * queries).sum(axis=1)) + 1e-3
        alive = query_ids[:, None] != self.ids[None, :]
        unbounded = is_large(queries)[:, None] | self.large[None, :]
        take = min(2 * k, n)
        for count, level in zip(self.counts, self.levels):
            statistics = segment_statistics(queries, count)
            n_alive = np.count_nonzero(alive)
            if n_alive > n_queries * n // DENSE:
                bounds = np.where(alive, statistics @ level.T, -np.inf)
            else:
                q, c = np.nonzero(alive)
                bounds = np.full((n_queries, n), -np.inf)
                bounds[q, c] = np.einsum("ij,ij->i", statistics[q], level[c])
            bounds[unbounded & alive] = np.inf
            tops = np.argpartition(-bounds, take - 1, axis=1)[:, :take]
            top_q, top_c = np.repeat(np.arange(n_queries), take), tops.ravel()
            real = alive[top_q, top_c]
            sure = np.full(n_queries * take, -np.inf)
            sure[real] = self.products(queries, top_q[real], top_c[real])
            if take >= k:
                kth = np.partition(sure.reshape(n_queries, take), take - k, axis=1)[:, take - k]
                threshold = np.maximum(threshold, kth)
            alive &= bounds + slack[:, None] >= threshold[:, None]
        q, c = np.nonzero(alive)
        score = self.products(queries, q, c)
        good = score >= threshold[q]
        return q[good], c[good], score[good]


def best_of_block(block: Block, query_ids, queries, k: int) -> pd.DataFrame:
    parts = []
    for lo in range(0, len(queries), SLICE):
        own_ids = query_ids[lo : lo + SLICE]
        q, c, score = block.search(own_ids, queries[lo : lo + SLICE], k)
        order = np.lexsort((block.ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        first = np.searchsorted(q, q)  # where the row's query begins
        best = np.arange(len(q)) - first < k
        parts.append((own_ids[q[best]], block.ids[c[best]], score[best]))
    columns = [np.concatenate([part[i] for part in parts]) for i in range(3)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))


def blocks_for(rows: int, components: int | None, rows_per_block: int) -> int:
    """Blocks that hold at most so many rows and ``BLOCK_COMPONENTS`` each, on average."""
    return max(1, -(-rows // rows_per_block), -(-(components or 0) // BLOCK_COMPONENTS))


def exact_top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest products of quantised vectors.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but those with
    the query's id. Components become ``floor(scale * x)``. Vectors that are null or empty or
    hold null or non-finite components take no part, nor do rows without id. Scores are exact
    however large the components; one that does not fit a long is an error. Vectors meet vectors of the same length. Of rows that share an
    id the smallest vector counts. Ties go to the smaller id.

    Candidates and queries are dealt by hash into blocks of bounded size, and every pair of
    blocks is one task's group; a group returns at most ``k`` rows per query.
    """
    valid = checkpointed(usable_vectors(vectors, id_col, vector_col, nonzero=False), "vectors")
    is_query = F.col("id") % every == 0
    asked = F.when(is_query, F.col("size"))
    n, size, n_queries, query_size = valid.agg(
        F.count("*"), F.sum("size"), F.count(asked), F.sum(asked)
    ).first()
    n_blocks = blocks_for(n, size, CANDIDATE_BLOCK)
    n_query_blocks = blocks_for(n_queries, query_size, QUERY_BLOCK)

    def block_of(blocks: int, salt: str):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(blocks)).cast("int")

    def all_of(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    candidates = valid.select(
        "*", F.lit(False).alias("asks"), block_of(n_blocks, "c").alias("block")
    ).withColumn("query_block", all_of(n_query_blocks))
    queries = valid.where(is_query).select(
        "*", F.lit(True).alias("asks"), all_of(n_blocks).alias("block")
    ).withColumn("query_block", block_of(n_query_blocks, "q"))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        values = quantised(stacked(group["vector"]), scale)
        ids = group["id"].to_numpy(np.int64)
        return best_of_block(Block(ids[~asks], values[~asks]), ids[asks], values[asks], k)

    found = (
        candidates.unionByName(queries)
        .groupBy("size", "block", "query_block")
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    return ranked(found, k, F.col("score").desc())

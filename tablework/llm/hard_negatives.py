"""Hard negatives by rotated one-bit codes with the vectors' alignment to them.

A vector is turned by a fixed random rotation, and of each component the sign is kept: a code, which
stands for the unit vector of these signs. Beside it stand the vector's norm and its alignment, the
inner product with its code's vector. A query turned likewise is rounded to a few bits a component,
so that its inner product with a code is a sum of popcounts. What vector and query have beside the
code's direction is bounded by Cauchy and Schwarz, and so is what rounding took from the query: every
pair has an interval that surely holds its score. Only pairs whose interval reaches into what is
asked for are scored, by integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from tablework.llm.topk import large_products, quantised
from tablework.llm.vectors import stacked
from tablework.workspace import checkpointed

#: Components that the vectors of one block hold at most, and the fewest vectors worth a block.
BLOCK_COMPONENTS, LEAST_BLOCK = 1 << 22, 1024
#: Bits of a rounded query component.
PLANES = 6
#: Pairs whose intervals are held at a time.
TILE = 1 << 19
#: Stands where there is no score.
NONE = np.iinfo(np.int64).min


@lru_cache(maxsize=4)
def rotation(size: int) -> np.ndarray:
    """A fixed random rotation (an orthogonal matrix) of vectors of this length."""
    turned, upper = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))
    return turned * np.sign(np.diag(upper))


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    packed = np.packbits(bits, axis=1)
    padded = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def one_bit_codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the code's words, the alignment with the code's vector and the norm."""
    turned = vectors @ rotation(vectors.shape[1])
    alignment = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return words(turned >= 0), alignment, np.sqrt((vectors * vectors).sum(axis=1))


def is_large(vectors: np.ndarray) -> np.ndarray:
    """Rows whose products might overflow 64-bit sums; they go without intervals."""
    return (np.abs(vectors) >= np.sqrt(2.0**62 / vectors.shape[1])).any(axis=1)


class RoundedQueries:
    """Queries turned and rounded to ``PLANES`` bits a component."""

    def __init__(self, vectors: np.ndarray):
        size = vectors.shape[1]
        turned = vectors @ rotation(size)
        low = turned.min(axis=1)
        step = (turned.max(axis=1) - low) / (2**PLANES - 1)
        steps = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1)[:, None])
        rounded = low[:, None] + step[:, None] * steps
        self.low, self.step, self.root = low, step, np.sqrt(size)
        self.sums = rounded.sum(axis=1)
        self.squares = (rounded * rounded).sum(axis=1)
        self.lost = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
        planes = steps.astype(np.uint8)
        self.planes = [words(planes >> bit & 1) for bit in range(PLANES)]

    def intervals(self, part: slice, codes, ones, alignment, norm, residual):
        """Lowest and highest possible scores of the queries in ``part`` with the coded vectors."""
        picked = np.zeros((part.stop - part.start, len(codes)))
        for bit, plane in enumerate(self.planes):
            for word in range(codes.shape[1]):
                common = np.bitwise_count(plane[part, word, None] & codes[None, :, word])
                picked += common * float(2**bit)
        picked *= self.step[part, None]
        picked += self.low[part, None] * ones
        along = (2 * picked - self.sums[part, None]) / self.root
        middle = along * alignment
        beside = np.sqrt(np.maximum(self.squares[part, None] - along * along, 0.0))
        beside *= residual
        query_norm = np.sqrt(self.squares[part]) + self.lost[part]
        # The last term covers what doubles lose on the way.
        beside += (self.lost[part] + 1e-9 * query_norm)[:, None] * norm + 1e-6
        return middle - beside, middle + beside


class Candidates:
    """Vectors of a block with their codes."""

    def __init__(self, group: pd.DataFrame, scale: int):
        self.rows, self.ids = group["row"].to_numpy(np.int64), group["id"].to_numpy(np.int64)
        self.labels = group["label"].to_numpy()
        self.vectors = quantised(stacked(group["vector"]), scale)
        self.large = is_large(self.vectors)
        self.codes = np.frombuffer(b"".join(group["code"]), np.uint64).reshape(len(group), -1)
        self.ones = np.bitwise_count(self.codes).sum(axis=1).astype(float)
        self.alignment, self.norm = group["alignment"].to_numpy(), group["norm"].to_numpy()
        self.residual = np.sqrt(np.maximum(self.norm**2 - self.alignment**2, 0.0))


class Anchors:
    """Query vectors of a block; scores with candidates are exact integers."""

    def __init__(self, group: pd.DataFrame, scale: int):
        self.rows, self.labels = group["row"].to_numpy(np.int64), group["label"].to_numpy()
        self.vectors = quantised(stacked(group["vector"]), scale)
        self.large = is_large(self.vectors)
        with np.errstate(all="ignore"):
            self.rounded = RoundedQueries(np.where(self.large[:, None], 0.0, self.vectors))

    def scores(self, candidates: Candidates, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        exact = np.empty(len(q), np.int64)
        rare = self.large[q] | candidates.large[c]
        if rare.any():
            exact[rare] = large_products(self.vectors[q[rare]], candidates.vectors[c[rare]])
        common = np.flatnonzero(~rare)
        for at in range(0, len(common), TILE):
            some = common[at : at + TILE]
            exact[some] = np.einsum(
                "ij,ij->i",
                self.vectors[q[some]].astype(np.int64),
                candidates.vectors[c[some]].astype(np.int64),
            )
        return exact

    def scored(self, candidates: Candidates, part: slice, mask: np.ndarray) -> np.ndarray:
        """Scores of the pairs in ``mask``, ``NONE`` elsewhere.

        Where many pairs are left, they are one matrix product: sums of integers that no sum of
        absolute products can bring to 2^53 are exact in doubles.
        """
        exact = np.full(mask.shape, NONE)
        some = np.count_nonzero(mask) * 16 > mask.size
        largest = np.sqrt((self.vectors[part] ** 2).sum(axis=1).max()) * candidates.norm.max()
        if some and largest < 2.0**53:
            products = self.vectors[part] @ candidates.vectors.T
            np.copyto(exact, products.astype(np.int64), where=mask)
        else:
            q, c = np.nonzero(mask)
            exact[q, c] = self.scores(candidates, q + part.start, c)
        return exact

    def tiles(self, candidates: Candidates) -> Iterator[tuple]:
        """Slices of the anchors, the intervals of their scores with all candidates, and the middles."""
        height = max(1, TILE // len(candidates.rows))
        for at in range(0, len(self.rows), height):
            part = slice(at, min(at + height, len(self.rows)))
            with np.errstate(all="ignore"):
                low, high = self.rounded.intervals(
                    part, candidates.codes, candidates.ones, candidates.alignment,
                    candidates.norm, candidates.residual,
                )
            if self.large[part].any() or candidates.large.any():
                unbounded = self.large[part, None] | candidates.large
                low[unbounded], high[unbounded] = -np.inf, np.inf
            with np.errstate(invalid="ignore"):
                yield part, low, high, (low + high) / 2


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest score of each row, ``NONE`` where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), NONE)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def promising(middle: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` allowed pairs of each row whose intervals lie highest: rows and columns."""
    middle = np.where(allowed, middle, -np.inf)
    middle[np.isnan(middle)] = 0.0  # intervals without bounds
    n = min(n, middle.shape[1])
    columns = np.argpartition(-middle, n - 1, axis=1)[:, :n].ravel()
    rows = np.repeat(np.arange(len(middle)), n)
    real = allowed[rows, columns]
    return rows[real], columns[real]


def best_pairs(key: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """Places of each key's ``k`` best pairs: highest score, then smallest id, then row."""
    order = np.lexsort((rows, ids, -score, key))
    ordered = key[order]
    return order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k]


def sure_threshold(anchors, candidates, part, pairs, fits, k: int) -> np.ndarray:
    """The k-th best exact score among each row's few ``pairs`` that fit."""
    q, c = pairs
    score = anchors.scores(candidates, q + part.start, c)
    fit = fits(q, score)
    width = np.bincount(q, minlength=1).max(initial=1)
    table = np.full((part.stop - part.start, max(width, k)), NONE)
    place = np.arange(len(q)) - np.searchsorted(q, q)
    table[q[fit], place[fit]] = score[fit]
    return kth_best(table, k)


def positives_of_block(anchors: Anchors, candidates: Candidates, k: int) -> pd.DataFrame:
    """Pairs of the same label that hold each anchor's ``k`` best."""
    found = []
    for part, low, high, middle in anchors.tiles(candidates):
        allowed = anchors.labels[part, None] == candidates.labels
        allowed &= anchors.rows[part, None] != candidates.rows
        pairs = promising(middle, allowed, 2 * k)
        threshold = sure_threshold(
            anchors, candidates, part, pairs, lambda q, score: np.ones(len(q), bool), k
        )
        score = anchors.scored(candidates, part, allowed & (high >= threshold[:, None]))
        q, c = np.nonzero((score >= kth_best(score, k)[:, None]) & (score != NONE))
        best = best_pairs(q, score[q, c], candidates.ids[c], candidates.rows[c], k)
        q, c = q[best], c[best]
        found.append(
            (anchors.rows[q + part.start], candidates.rows[c], candidates.ids[c], score[q, c])
        )
    columns = [np.concatenate([some[i] for some in found]) for i in range(4)]
    return pd.DataFrame(dict(zip(("anchor", "row", "id", "score"), columns)))


def limits(positive: np.ndarray, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and the highest score in the window: ``a * p <= 100 * score <= b * p``.

    Hundreds and what is beside them are taken apart, so that nothing overflows.
    """
    whole, rest = np.divmod(positive, 100)
    return window[0] * whole - (-window[0] * rest // 100), window[1] * whole + window[1] * rest // 100


def negatives_of_block(
    anchors: Anchors, candidates: Candidates, positives: list, k: int, window: tuple[int, int]
) -> pd.DataFrame:
    """Pairs of different labels that hold the ``k`` best in the window of each positive score."""
    names = ("anchor", "positive_score", "row", "id", "score")
    counts = [len(scores) for scores in positives]
    owner = np.repeat(np.arange(len(counts)), counts)  # the anchor of each (anchor, score)
    asked = np.concatenate([np.asarray(scores, np.int64) for scores in positives])
    owner, asked = owner[asked >= 0], asked[asked >= 0]
    least = np.full(len(counts), np.iinfo(np.int64).max)
    most = np.full(len(counts), -1)
    np.minimum.at(least, owner, asked)
    np.maximum.at(most, owner, asked)
    asks = most >= 0
    least[~asks] = 0
    bottom, near = limits(least, window)  # the window of the least positive score
    top = limits(np.maximum(most, 0), window)[1]
    found = [tuple(np.empty(0, np.int64) for _ in names)]
    for part, low, high, middle in anchors.tiles(candidates):
        allowed = anchors.labels[part, None] != candidates.labels
        allowed &= asks[part, None]
        allowed &= (low <= top[part, None]) & (high >= bottom[part, None])
        pairs = promising(middle, allowed & ~(middle > near[part, None]), 2 * k)
        threshold = sure_threshold(
            anchors, candidates, part, pairs,
            lambda q, score: (score >= bottom[part][q]) & (score <= near[part][q]), k,
        )
        score = anchors.scored(candidates, part, allowed & (high >= threshold[:, None]))
        score[(score < bottom[part, None]) | (score > top[part, None])] = NONE
        # All that the least positive takes, and what lies between its window's top and the others'.
        worst = kth_best(np.where(score <= near[part, None], score, NONE), k)
        q, c = np.nonzero((score >= worst[:, None]) & (score != NONE))
        exact = score[q, c]
        lines = np.flatnonzero((owner >= part.start) & (owner < part.stop))
        # Each pair once for every positive score of its anchor.
        first, last = (np.searchsorted(owner[lines], q + part.start, side) for side in ("left", "right"))
        pair = np.repeat(np.arange(len(q)), last - first)
        line = lines[first[pair] + np.arange(len(pair)) - np.searchsorted(pair, pair)]
        lowest, highest = limits(asked[line], window)
        fits = (exact[pair] >= lowest) & (exact[pair] <= highest)
        pair, line = pair[fits], line[fits]
        best = best_pairs(line, exact[pair], candidates.ids[c[pair]], candidates.rows[c[pair]], k)
        pair, line = pair[best], line[best]
        found.append(
            (anchors.rows[owner[line]], asked[line], candidates.rows[c[pair]],
             candidates.ids[c[pair]], exact[pair])
        )
    columns = [np.concatenate([some[i] for some in found]) for i in range(5)]
    return pd.DataFrame(dict(zip(names, columns)))


def coded_vectors(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``row, id, label, size, vector, code, alignment, norm`` of the rows that take part."""

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    usable = (
        df.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            label.alias("label"),
            F.col(f"`{vector_col}`").alias("vector"),
        )
        .where("id is not null and label is not null and size(vector) > 0")
        .where(F.forall("vector", finite))
        .select(
            F.monotonically_increasing_id().alias("row"), "id", "label", "vector",
            F.size("vector").alias("size"),
        )
    )
    added = [StructField("code", BinaryType())]
    added += [StructField(name, DoubleType()) for name in ("alignment", "norm")]
    schema = StructType(usable.schema.fields + added)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, group in batch.groupby("size"):
                with np.errstate(all="ignore"):
                    codes, alignment, norm = one_bit_codes(quantised(stacked(group["vector"]), scale))
                code = [row.tobytes() for row in codes]
                yield group.assign(code=code, alignment=alignment, norm=norm)

    return checkpointed(usable.mapInPandas(coded, schema), "coded")


def mine_hard_negatives(
    vectors: DataFrame,
    label: Column | str = "label",
    n_positives: int = 5,
    n_negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    every: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``. Components become
    ``floor(scale * x)``, and scores are exact integer inner products; the higher comes first, and
    ties go to the smaller id. An anchor's positives are its first ``n_positives`` other rows of the
    same ``label``, and for each of them the first ``n_negatives`` rows of other labels are returned
    whose score is between the ``window``'s percentages of the positive one; fewer where there
    are fewer. A positive with a negative score has none.

    Rows without id, label or vector take no part, nor do vectors that are empty or hold null or
    non-finite components. Every other row counts, repeated rows and rows that share an id as well:
    each is an anchor or a candidate of its own, and of copies it doesn't matter which one comes
    first. Vectors meet vectors of the same length. Other columns stay out, and an empty table
    gives an empty result. Components may be of any size; a score beyond a long is an error.

    Anchors meet all rows in blocks of bounded size, dealt by hash; every pair of blocks is one
    task's group and returns at most as many rows per anchor as are asked for.
    """
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    valid = coded_vectors(vectors, id_col, vector_col, label, scale)
    is_anchor = F.col("id") % every == 0
    n, n_anchors, size = valid.agg(
        F.count("*"), F.count(F.when(is_anchor, 1)), F.max("size")
    ).first()
    spread = 2 * valid.sparkSession.sparkContext.defaultParallelism
    largest = max(LEAST_BLOCK, BLOCK_COMPONENTS // (size or 1))
    n_blocks = max(1, -(-n // largest), min(spread, -(-n // LEAST_BLOCK)))
    n_anchor_blocks = max(1, -(-n_anchors // largest))

    def dealt(blocks: int, salt: str) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(blocks)).cast("int")

    def each(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    candidates = valid.select("*", dealt(n_blocks, "c").alias("block")).withColumns(
        {"anchor_block": each(n_anchor_blocks), "asks": F.lit(False), "scores": F.lit(None).cast("array<long>")}
    )

    def in_blocks(anchors: DataFrame, search, schema: str) -> DataFrame:
        anchors = anchors.withColumn("anchor_block", dealt(n_anchor_blocks, "a"))
        anchors = anchors.withColumn("block", each(n_blocks))

        def run(group: pd.DataFrame) -> pd.DataFrame:
            asks = group["asks"].to_numpy()
            if asks.all() or not asks.any():
                names = [field.split()[0] for field in schema.split(", ")]
                return pd.DataFrame({name: np.empty(0, np.int64) for name in names})
            return search(
                Anchors(group[asks], scale), Candidates(group[~asks], scale),
                group.loc[asks, "scores"].tolist(),
            )

        both = candidates.unionByName(anchors.select(*candidates.columns))
        return both.groupBy("size", "block", "anchor_block").applyInPandas(run, schema)

    def first(pairs: DataFrame, k: int, *of: str) -> DataFrame:
        order = Window.partitionBy(*of).orderBy(F.col("score").desc(), "id", "row")
        return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    anchors = valid.where(is_anchor).withColumns(
        {"asks": F.lit(True), "scores": F.lit(None).cast("array<long>")}
    )
    pairs = in_blocks(
        anchors,
        lambda asked, known, _: positives_of_block(asked, known, n_positives),
        "anchor long, row long, id long, score long",
    )
    positives = checkpointed(first(pairs, n_positives, "anchor"), "positives")
    asked_scores = positives.groupBy("anchor").agg(F.collect_set("score").alias("scores"))
    asking = (
        valid.where(is_anchor)
        .join(asked_scores, F.col("row") == F.col("anchor"))
        .withColumn("asks", F.lit(True))
    )
    pairs = in_blocks(
        asking,
        lambda asked, known, scores: negatives_of_block(asked, known, scores, n_negatives, window),
        "anchor long, positive_score long, row long, id long, score long",
    )
    negatives = first(pairs, n_negatives, "anchor", "positive_score").select(
        "anchor", "positive_score", "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = positives.select(
        "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(valid.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.join(negatives, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

"""Near-duplicates by SimHash fingerprints and a hierarchical index in Gray order.

All fingerprints are sorted by Gray rank, so that neighbours differ in few bits, and cut into leaves of
equal size; sixteen nodes in a row have one node above them, and so on up. Bits that all codes below
a node share are factored into its mask and pattern. Two nodes are at least as far apart as their
patterns where both masks hold. The search goes down from the pairs of topmost nodes: differences add
up as the masks grow, and a pair of nodes is passed over, with all that lies below, once they exceed
the limit. Codes travel only for the pairs of leaves that are left, and below these the same tree and
the same search go on within the task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.columns import ROW, packed, unpacked
from tablework.llm.graph import component_roots
from tablework.workspace import checkpointed

SEED = 42
MAX_BITS = 2
#: Codes of a leaf, and nodes below a node.
LEAF = 2048
FANOUT = 16
#: Pairs of nodes that are followed downwards side by side.
BLOCK = 4096


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """The signed 64-bit SimHash of a text's word shingles; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(shingle, len(words))
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        hi = min(n, lo + 65536)
        cuts = zip(starts[lo:hi].tolist(), ends[lo + width - 1 : hi + width - 1].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in cuts), np.uint64, hi - lo)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > n, bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprints(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(text, shingle) for text in texts], dtype="int64")

    return compute(text)


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit code in the binary-reflected Gray sequence.

    A fold over the shifts, as nested expressions would double with every shift. Negative ranks are
    the second half of the sequence, which goes round, so any order by rank keeps neighbours.
    """
    shifts = F.array(*[F.lit(2**i) for i in range(6)])
    return F.aggregate(
        shifts,
        code,
        lambda rank, by: rank.bitwiseXOR(F.call_function("shiftrightunsigned", rank, by)),
    )


class CodeTree:
    """Codes in Gray order below nodes that hold the bits shared by all codes under them."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels = []  # from the widest nodes to the codes: (mask, pattern)
        low = high = codes
        while True:
            mask = ~(low ^ high)
            self.levels.append((mask, low & mask))
            if len(low) <= FANOUT:
                break
            cuts = np.arange(0, len(low), FANOUT)
            low, high = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)
        self.levels.reverse()

    def below(self, depth: int, node: np.ndarray) -> np.ndarray:
        """The children of nodes at ``depth``, one row per node; those beyond the end are -1."""
        children = node[:, None] * FANOUT + np.arange(FANOUT)
        children[children >= len(self.levels[depth + 1][0])] = -1
        return children

    def near(self, other: CodeTree, limit: int):
        """Blocks of pairs (own place, other's place) of codes at most ``limit`` bits apart."""

        def close(depth, other_depth, x, y):
            mask, pattern = self.levels[depth]
            other_mask, other_pattern = other.levels[other_depth]
            differing = (pattern[x] ^ other_pattern[y]) & mask[x] & other_mask[y]
            kept = np.bitwise_count(differing) <= limit
            return x[kept], y[kept]

        last, other_last = len(self.levels) - 1, len(other.levels) - 1
        tops, other_tops = len(self.levels[0][0]), len(other.levels[0][0])
        x, y = np.divmod(np.arange(tops * other_tops), other_tops)
        waiting = [(0, 0, *close(0, 0, x, y))]
        while waiting:
            depth, other_depth, x, y = waiting.pop()
            if len(x) > BLOCK:
                waiting.append((depth, other_depth, x[BLOCK:], y[BLOCK:]))
                x, y = x[:BLOCK], y[:BLOCK]
            left, other_left = last - depth, other_last - other_depth
            if not left and not other_left:
                if len(x):
                    yield x, y
                continue
            # The tree with more levels left goes down, or both do.
            if left >= other_left:
                children = self.below(depth, x)
                x, y = children.ravel(), np.repeat(y, FANOUT)
                x, y = x[x >= 0], y[x >= 0]
            if other_left >= left:
                children = other.below(other_depth, y)
                x, y = np.repeat(x, FANOUT), children.ravel()
                x, y = x[y >= 0], y[y >= 0]
            depth, other_depth = depth + (left >= other_left), other_depth + (other_left >= left)
            waiting.append((depth, other_depth, *close(depth, other_depth, x, y)))


def merge_links(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of linked elements in ``parent``; roots are smallest elements."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = parent[parent]
            if np.array_equal(shorter, parent):
                break
            parent[:] = shorter


def spanning_links(one: np.ndarray, two: np.ndarray, limit: int):
    """Links that connect the codes of two leaves that lie within ``limit`` bits.

    At most one link per code comes back, to the smallest place that its links reach.
    """
    codes = np.concatenate([one, two])
    parent = np.arange(len(codes))
    for x, y in CodeTree(one).near(CodeTree(two), limit):
        merge_links(parent, x, len(one) + y)
    linked = np.flatnonzero(parent != np.arange(len(parent)))
    linked = linked[codes[linked] != codes[parent[linked]]]  # a leaf beside itself holds codes twice
    return codes[linked].view(np.int64), codes[parent[linked]].view(np.int64)


def gray_leaves(codes: DataFrame) -> DataFrame:
    """``number, low, high, codes``: leaves of at most ``LEAF`` codes, numbered in Gray order.

    Tasks sort ranges of ranks and cut them; what the numbers of a range begin with comes from one
    count per range. ``low`` and ``high`` are the codes' common bits and all of their bits.
    """
    ranked = codes.select("code", gray_rank(F.col("code")).alias("rank"))
    ordered = ranked.repartitionByRange("rank").sortWithinPartitions("rank")
    place = F.monotonically_increasing_id()
    row = place.bitwiseAND(F.lit(2**33 - 1))
    ordered = checkpointed(
        ordered.select(
            "code", F.shiftright(place, 33).alias("range"), F.floor(row / LEAF).alias("leaf")
        ),
        "gray-order",
    )
    sizes = ordered.groupBy("range").agg((F.max("leaf") + 1).alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = ordered.join(sizes, "range").groupBy((F.col("before") + F.col("leaf")).alias("number"))
    return checkpointed(
        numbered.agg(
            F.bit_and("code").alias("low"),
            F.bit_or("code").alias("high"),
            F.array_sort(F.collect_list(F.struct(gray_rank(F.col("code")).alias("rank"), "code")))
            .getField("code")
            .alias("codes"),
        ),
        "gray-leaves",
    )


def apart(one: str, two: str) -> Column:
    """Bits in which all codes below two nodes differ: where patterns do and both masks hold."""
    differing = F.col(f"{one}_low").bitwiseXOR(F.col(f"{two}_low"))
    for side in (one, two):
        differing = differing.bitwiseAND(
            F.bitwise_not(F.col(f"{side}_low").bitwiseXOR(F.col(f"{side}_high")))
        )
    return F.bit_count(differing)


def near_leaves(leaves: DataFrame, limit: int) -> DataFrame:
    """Pairs ``x, y`` of leaf numbers, x up to y, that may hold codes within ``limit`` bits."""
    levels = [leaves.select("number", "low", "high")]
    size = levels[0].count()
    while size > FANOUT:
        above = levels[-1].groupBy(F.shiftright("number", 4).alias("number"))
        nodes = above.agg(F.bit_and("low").alias("low"), F.bit_or("high").alias("high"))
        levels.append(checkpointed(nodes, "gray-nodes"))
        size = -(-size // FANOUT)

    def named(nodes: DataFrame, side: str) -> DataFrame:
        return nodes.select(*[F.col(name).alias(f"{side}_{name}") for name in nodes.columns])

    def meet(pairs: DataFrame, nodes: DataFrame, side: str) -> DataFrame:
        return pairs.join(named(nodes, side), F.col(side) == F.col(f"{side}_number"))

    def down(column: str) -> Column:
        steps = F.array(*[F.lit(i) for i in range(FANOUT)])
        return F.explode(F.transform(steps, lambda i: F.col(column) * FANOUT + i))

    top = levels[-1].select(F.col("number").alias("x"), F.explode(F.sequence("number", F.lit(size - 1))).alias("y"))
    pairs = meet(meet(top, levels[-1], "x"), levels[-1], "y")
    pairs = checkpointed(pairs.where(apart("x", "y") <= limit).select("x", "y"), "gray-pairs")
    for above, nodes in zip(levels[:0:-1], levels[-2::-1]):
        # One side goes down first and is held against the other's parent.
        half = meet(meet(pairs.select(down("x").alias("x"), "y"), nodes, "x"), above, "y")
        half = half.where(apart("x", "y") <= limit).select("x", "x_low", "x_high", down("y").alias("y"))
        whole = meet(half.where("x <= y"), nodes, "y").where(apart("x", "y") <= limit)
        pairs = checkpointed(whole.select("x", "y"), "gray-pairs")
    return pairs


def link_codes(codes: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct ``codes`` within ``limit`` bits."""

    def search(batches):
        for batch in batches:
            for one, two in zip(batch["one"], batch["two"]):
                sides = [np.asarray(side, np.int64).view(np.uint64) for side in (one, two)]
                a, b = spanning_links(*sides, limit)
                if len(a):
                    yield pd.DataFrame({"a": a, "b": b})

    leaves = gray_leaves(codes)
    pairs = near_leaves(leaves, limit)
    one = leaves.select(F.col("number").alias("x"), F.col("codes").alias("one"))
    two = leaves.select(F.col("number").alias("y"), F.col("codes").alias("two"))
    met = pairs.join(one, "x").join(two, "y").select("one", "two")
    return met.mapInPandas(search, "a long, b long")


def groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """``id, text_hash, code, root, component_id`` for every row of ``docs``."""
    coded = checkpointed(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
            fingerprints(F.col(f"`{text_col}`"), shingle).alias("code"),
        ),
        "fingerprints",
    )
    nodes = checkpointed(coded.groupBy("code").agg(F.min("id").alias("first_id")), "nodes")
    roots = component_roots(link_codes(nodes.select("code"), max_bits))
    placed = checkpointed(
        nodes.join(roots, F.col("code") == F.col("node"), "left").select(
            "code", "first_id", F.coalesce("root", "code").alias("root")
        ),
        "placed",
    )
    firsts = checkpointed(
        placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "firsts"
    )
    named = checkpointed(
        placed.join(firsts, "root").select(
            F.col("code").alias("of_code"), "root", "component_id"
        ),
        "components",
    )
    return coded.join(named, F.col("code") == F.col("of_code")).drop("of_code")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``code`` (the fingerprint) and ``component_id``.

    Texts whose fingerprints differ in at most ``max_bits`` bits are linked, and the component's
    id is the smallest id that links reach. Null, empty and blank texts have fingerprint zero.
    Rows without id take part; a component of such rows only has no id. Equal fingerprints are
    one node from the start, so copies and repeated rows never meet as pairs. Texts may be of any
    length: words are counted piece by piece. An empty table gives an empty result. Other columns
    are not read.
    """
    found = groups(docs, id_col, text_col, shingle, max_bits)
    return found.select(F.col("id").alias(id_col), "code", "component_id")


def fingerprint_text(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def one_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id.

    Rows without id come after all others; among rows of one id the smallest hash of the text
    decides, and equal rows count once.
    """
    choice = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    kept = checkpointed(
        groups(docs, id_col, text_col, shingle, max_bits)
        .groupBy("root")
        .agg(F.min(choice).alias("kept"))
        .select(F.col("kept.id").alias("kept_id"), F.col("kept.text_hash").alias("kept_hash")),
        "kept",
    )
    rows = packed(docs, id=F.col(f"`{id_col}`"), text_hash=F.xxhash64(F.col(f"`{text_col}`")))
    chosen = rows.join(
        kept,
        F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")),
    ).dropDuplicates(["id", "text_hash"])
    return unpacked(chosen.select(ROW), docs.columns)

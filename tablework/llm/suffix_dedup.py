"""Remove byte strings that occur anywhere else, by anchors, hashes and orders around anchors.

A string of ``LENGTH`` bytes is judged by where it starts. Every start has an anchor, the
smallest hashed gram among the ``SPREAD`` grams that follow, so equal strings have anchors at
equal distance; neighbouring starts with the same anchor form a run, whose text is a piece.
Equal strings lie in runs with equal text behind the anchor (the core). Runs whose core is
unique are done; runs with an equal twin are repeated as a whole, and the twins go on as one
piece with their number. Only differing pieces around one core are left, the ends of repeats.

These are sorted by radix, one preceding symbol per step; no shard has an order or a
Burrows-Wheeler transform of its own that would be merged. Steps run from the far end of the pieces to the core, over the
core at once, and on through the bytes before it. The common prefixes of neighbours behind the
core are derived once, and a range minimum gives them for rows that become neighbours later. At
distance d before the core, two neighbours of a block that share enough behind it hold the same
string, so blocks are the repeated intervals.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.columns import ROW, packed, unpacked
from tablework.workspace import checkpointed

LENGTH = 200
#: Grams an anchor is chosen from (a power of two), and their bytes.
SPREAD, GRAM = 128, 16
#: Bytes whose runs are sought at a time; a run may end there, which costs work only.
SEGMENT = 1_000_000
#: Different pieces around one core up to which they are refined together; the strings of more
#: crowded cores are hashed one by one and counted in Spark.
CROWD = 20_000
#: Pieces gathered before they are sorted.
GATHERED = 20_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)

KEY = ["k1", "k2"]
PLACE = "first int, n_starts int, lead int"
RUN = f"k1 long, k2 long, {PLACE}, core long, piece long"


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, inverse, np.uint64)])
    return up, down


def anchor_leads(data: np.ndarray, spread: int, gram: int) -> np.ndarray:
    """For each start the distance to the leftmost smallest gram among ``spread``."""
    up, down = _powers(1 << max(20, int(len(data)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])]
        grams = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
        value = ((grams * _MIX) >> np.uint64(32)).astype(np.uint32)
    lead, step = np.zeros(len(value), np.uint8), 1
    while step < spread:
        later = value[step:] < value[:-step]
        value = np.where(later, value[step:], value[:-step])
        lead = np.where(later, lead[step:] + np.uint8(step), lead[:-step])
        step *= 2
    return lead


def segments(texts):
    """(row, offset, bytes) of stretches that together hold all starts."""
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text)), SEGMENT):
            yield row, offset, text


def joined_segments(texts, length: int):
    """Groups of short stretches: their bytes and, for each, row, offset, begin and starts."""
    parts, table, size = [], [], 0
    for row, offset, text in segments(texts):
        starts = min(SEGMENT, len(text) - length + 1 - offset)
        if starts <= 0:
            continue
        part = text[offset : offset + starts + length - 1]
        table.append((row, offset, size, starts))
        parts.append(part)
        size += len(part)
        if size >= SEGMENT:
            yield b"".join(parts), table
            parts, table, size = [], [], 0
    if table:
        yield b"".join(parts), table


def runs_of(texts, length: int, spread: int, gram: int):
    """Arrays (row, first, n_starts, lead, core, piece) of all runs, a group at a time."""
    core_size = length - spread + 1
    core_hash, piece_hash = xxhash.xxh64_intdigest, xxhash.xxh3_64_intdigest
    for data, table in joined_segments(texts, length):
        leads = anchor_leads(np.frombuffer(data, np.uint8), spread, gram).astype(np.int64)
        rows, offsets, begins, counts = (np.array(column) for column in zip(*table))
        starts = np.repeat(begins - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(
            counts.sum()
        )
        anchors = starts + leads[starts]
        new = np.r_[True, (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)]
        at = np.flatnonzero(new)
        n_starts = np.diff(np.r_[at, len(starts)])
        first, anchor = starts[at], anchors[at]
        owner = np.searchsorted(begins, first, side="right") - 1
        lead = anchor - first
        core = np.fromiter(
            (core_hash(data[a : a + core_size]) for a in anchor.tolist()), np.uint64, len(at)
        )
        ends = first + n_starts - 1 + length
        piece = np.fromiter(
            (
                piece_hash(data[a:b], n << 8 | d)
                for a, b, n, d in zip(
                    first.tolist(), ends.tolist(), n_starts.tolist(), lead.tolist()
                )
            ),
            np.uint64,
            len(at),
        )
        place = first - begins[owner] + offsets[owner]
        yield rows[owner], place, n_starts, lead, core.view(np.int64), piece.view(np.int64)


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Symbols that each row of ``order`` shares with the row before it (0 for the first).

    A zero symbol stands behind a row's end and is never shared.
    """
    shared = np.zeros(len(order), np.int64)
    for lo in range(1, len(order), 8192):
        stop = min(lo + 8192, len(order))
        here, before = symbols[order[lo:stop]], symbols[order[lo - 1 : stop - 1]]
        differs = (here != before) | (here == 0)
        first = differs.argmax(axis=1)
        shared[lo:stop] = np.where(differs.any(axis=1), first, here.shape[1])
    return shared


class RangeMinimum:
    """Minima of stretches of an array, from minima of all stretches of powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values.astype(np.uint8)]
        step = 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over ``first..last``, both included."""
        sizes = last - first + 1
        found = np.empty(len(first), np.int64)
        depth = np.frexp(sizes.astype(float))[1] - 1
        for level in np.unique(depth):
            at = np.flatnonzero(depth == level)
            values = self.levels[level]
            found[at] = np.minimum(
                values[first[at]], values[last[at] - (1 << int(level)) + 1]
            )
        return found


def symbol_rows(parts: list[bytes], width: int) -> np.ndarray:
    """Rows of byte values plus one, with zeros behind the end."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    rows = np.zeros((len(parts), width), np.uint16)
    inside = np.arange(width) < sizes[:, None]
    rows[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 1
    return rows


def merged_order(shards: list[np.ndarray]) -> np.ndarray:
    """The order of all rows, sorted by radix from the last column to the first."""
    symbols = np.concatenate(shards)
    order = np.arange(len(symbols))
    for column in range(symbols.shape[1] - 1, -1, -1):
        order = order[np.argsort(symbols[order, column], kind="stable")]
    return order


def repeated_starts(
    cores: np.ndarray, leads: np.ndarray, pieces: list[bytes], length: int, spread: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, distance to the anchor) of starts whose string another row holds at that distance."""
    core_size, width = length - spread + 1, spread - 1
    behind = [piece[lead + core_size :] for piece, lead in zip(pieces, leads.tolist())]
    before = [piece[:lead][::-1] for piece, lead in zip(pieces, leads.tolist())]
    shard = 4096
    right = [symbol_rows(behind[lo : lo + shard], width) for lo in range(0, len(behind), shard)]
    order = merged_order(right)
    order = order[np.argsort(cores[order], kind="stable")]
    symbols = np.concatenate(right)
    shared = common_prefixes(symbols, order)
    minima = RangeMinimum(shared)
    left = symbol_rows(before, width)
    # Rows in merged order; a row's index in it stands for what follows the anchor.
    index = np.arange(len(order))
    block = np.cumsum(np.r_[0, cores[order][1:] != cores[order][:-1]])
    found_rows, found_distances = [], []
    for distance in range(spread):
        if distance:
            symbol = left[order[index], distance - 1].astype(np.int64)
            known = symbol > 0
            index, block, symbol = index[known], block[known], symbol[known]
            refined = np.argsort(block << 9 | symbol, kind="stable")
            index, block, symbol = index[refined], block[refined], symbol[refined]
            if len(index):
                block = np.cumsum(
                    np.r_[0, (block[1:] != block[:-1]) | (symbol[1:] != symbol[:-1])]
                )
        same = block[1:] == block[:-1]
        paired = np.r_[same, False] | np.r_[False, same]
        index, block = index[paired], block[paired]
        if not len(index):
            break
        same = np.flatnonzero(block[1:] == block[:-1])
        enough = minima.between(index[same] + 1, index[same + 1]) >= width - distance
        hits = np.zeros(len(index), bool)
        hits[same[enough]] = hits[same[enough] + 1] = True
        rows = order[index[hits]]
        found_rows.append(rows)
        found_distances.append(np.full(len(rows), distance))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_rows]), np.concatenate([empty, *found_distances])


def joined_spans(frame: pd.DataFrame, rows, distances, length: int) -> pd.DataFrame:
    """Spans (k1, k2, start, stop) of repeated starts; starts next to each other as one."""
    order = np.lexsort((-distances, rows))
    rows, distances = rows[order], distances[order]
    new = np.r_[True, (rows[1:] != rows[:-1]) | (distances[1:] != distances[:-1] - 1)]
    at = np.flatnonzero(new) if len(rows) else np.zeros(0, np.int64)
    last = np.r_[at[1:], len(rows)] - 1
    own = frame.iloc[rows[at]]
    anchor = own["first"].to_numpy(np.int64) + own["lead"].to_numpy(np.int64)
    return pd.DataFrame(
        {
            "k1": own["k1"].to_numpy(np.int64),
            "k2": own["k2"].to_numpy(np.int64),
            "start": anchor - distances[at],
            "stop": anchor - distances[last] + length if len(at) else anchor,
        }
    )


def squeezed(data: Column) -> Column:
    @F.pandas_udf("binary")
    def squeeze(column: pd.Series) -> pd.Series:
        compressor = zstandard.ZstdCompressor(level=1)
        return column.map(compressor.compress)

    return squeeze(data)


def _spans(rows: DataFrame, length: int, spread: int, gram: int, crowd: int) -> DataFrame:
    """``k1, k2, start, stop`` of all repeated strings in ``rows`` (k1, k2, data)."""
    if spread & (spread - 1) or not 2 <= spread <= 128 or spread + gram - 1 > length:
        raise ValueError("spread must be a power of two up to 128 and fit into the length")

    def find(batches):
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(np.int64), batch["k2"].to_numpy(np.int64)
            for row, *values in runs_of(batch["data"], length, spread, gram):
                names = ["first", "n_starts", "lead", "core", "piece"]
                yield pd.DataFrame({"k1": k1[row], "k2": k2[row], **dict(zip(names, values))})

    def cut(batches):
        inflate = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.itertuples(index=False):
                data = inflate.decompress(row.squeezed)
                stops = row.first + row.n_starts - 1 + length
                texts = [data[a:b] for a, b in zip(row.first.tolist(), stops.tolist())]
                columns = {name: getattr(row, name) for name in piece_columns}
                yield pd.DataFrame({"k1": row.k1, "k2": row.k2, **columns, "text": texts})

    def refine(batches):
        waiting = []

        def spans(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.reset_index(drop=True)
            row, distance = repeated_starts(
                frame["core"].to_numpy(np.int64), frame["lead"].to_numpy(np.int64),
                frame["text"].tolist(), length, spread,
            )
            single = frame["n"].to_numpy()[row] == 1
            return joined_spans(frame, row[single], distance[single], length)

        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) < GATHERED:
                continue
            frame = pd.concat(waiting)
            last = frame["core"].to_numpy() == frame["core"].iloc[-1]  # this core may go on
            if not last.all():
                yield spans(frame[~last])
            waiting = [frame[last]]
        if waiting:
            yield spans(pd.concat(waiting))

    def strings(batches):
        for batch in batches:
            n_starts = batch["n_starts"].to_numpy()
            step = np.arange(n_starts.sum()) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
            own = batch[["k1", "k2", "n", "first"]].loc[batch.index.repeat(n_starts)]
            digests = [
                xxhash.xxh3_128_digest(text[t : t + length])
                for text, n in zip(batch["text"], n_starts.tolist())
                for t in range(n)
            ]
            yield own.assign(digest=digests, start=own["first"].to_numpy() + step)

    piece_columns = ["core", "n_pieces", "n", "first", "n_starts", "lead"]
    runs = rows.select(*KEY, "data").mapInPandas(find, RUN)
    cores = checkpointed(
        runs.select(F.col("core").alias("known")).groupBy("known").count()
        .where("count > 1").select("known"),
        "cores",
    )
    shared = checkpointed(
        runs.join(cores, F.col("core") == F.col("known")).drop("known"), "shared-runs"
    )
    place = F.struct(*KEY, "first", "n_starts", "lead")
    twins = checkpointed(
        shared.groupBy("core", "piece").agg(F.count("*").alias("n"), F.min(place).alias("place")),
        "twins",
    )
    whole = checkpointed(
        twins.where("n > 1").select(F.col("core").alias("c"), F.col("piece").alias("p")), "whole"
    )
    spans = shared.join(
        whole, (F.col("core") == F.col("c")) & (F.col("piece") == F.col("p"))
    ).select(*KEY, F.col("first").alias("start"), F.expr(f"first + n_starts - 1 + {length}").alias("stop"))

    mixed = checkpointed(
        twins.groupBy(F.col("core").alias("mixed_core"))
        .agg(F.count("*").alias("n_pieces"), F.min("n").alias("least"))
        .where("n_pieces > 1 AND least = 1")
        .select("mixed_core", "n_pieces"),
        "mixed-cores",
    )
    wanted = (
        twins.join(mixed, F.col("core") == F.col("mixed_core"))
        .select("core", "n_pieces", "n", "place.*")
        .groupBy(F.col("k1").alias("w1"), F.col("k2").alias("w2"))
        .agg(F.collect_list(F.struct(*piece_columns)).alias("wanted"))
        .select("w1", "w2", *[F.col(f"wanted.{name}") for name in piece_columns])
    )
    pieces = (
        rows.select(*KEY, squeezed(F.col("data")).alias("squeezed"))
        .join(wanted, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")))
        .drop("w1", "w2")
        .mapInPandas(
            cut, f"k1 long, k2 long, core long, n_pieces long, n long, {PLACE}, text binary"
        )
    )
    span = "k1 long, k2 long, start int, stop int"
    crowded = mixed.where(F.col("n_pieces") > crowd)
    if not crowded.isEmpty():
        pieces = checkpointed(pieces, "pieces")
        single = checkpointed(
            pieces.where(F.col("n_pieces") > crowd)
            .select(*KEY, "first", "n_starts", "n", "text")
            .mapInPandas(
                strings, "k1 long, k2 long, n long, first int, digest binary, start int"
            ),
            "strings",
        )
        again = checkpointed(
            single.groupBy(F.col("digest").alias("repeated")).count().where("count > 1")
            .select("repeated"),
            "repeated-strings",
        )
        spans = spans.unionByName(
            single.where("n = 1").join(again, F.col("digest") == F.col("repeated"))
            .select(*KEY, "start", (F.col("start") + length).alias("stop"))
        )
        pieces = pieces.where(F.col("n_pieces") <= crowd)
    ends = (
        pieces.select("core", "n", *KEY, "first", "lead", "text")
        .repartition("core")
        .sortWithinPartitions("core")
        .mapInPandas(refine, span)
    )
    return spans.unionByName(ends)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    spread: int = SPREAD,
    gram: int = GRAM,
    crowd: int = CROWD,
) -> DataFrame:
    """All columns but the text, with ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``.

    Texts are UTF-8 bytes, null texts are empty. A byte goes if a string of ``length`` bytes
    around it also starts anywhere else, in the same text or another; strings are judged on the
    input and never reach over a text's ends. Rows are texts of their own, so a repeated row of
    ``length`` bytes or more loses everything; rows equal in id and text get the same result.
    Columns named like a result are replaced. Runs travel as hashes; of texts only the
    pieces around mixed cores and one compressed copy per join do.
    """
    data = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    own = [name for name in docs.columns if name != text_col]
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("\u0000"))
    rows = packed(docs.select(*[F.col(f"`{c}`") for c in docs.columns]), data=data, name=name)
    rows = rows.select(
        F.struct(*[F.col(f"{ROW}.`{c}`") for c in own]).alias(ROW),
        "data",
        F.xxhash64("name", "data").alias("k1"),
        F.xxhash64(F.lit(1), "data", "name").alias("k2"),
    )
    spans = (
        _spans(rows, length, spread, gram, crowd)
        .groupBy(F.col("k1").alias("s1"), F.col("k2").alias("s2"))
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        .select("s1", "s2", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))
    )

    @F.pandas_udf("kept binary, n_bytes long, n_removed long, n_spans long")
    def cut(small: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        inflate, results = zstandard.ZstdDecompressor(), []
        for packed_text, first, last in zip(small, starts, stops):
            text = inflate.decompress(packed_text)
            if first is None or not len(first):
                results.append((text, len(text), 0, 0))
                continue
            order = np.argsort(first, kind="stable")
            first, last = np.asarray(first)[order], np.maximum.accumulate(np.asarray(last)[order])
            new = np.r_[True, first[1:] > last[:-1]]
            begin = first[new]
            end = last[np.r_[np.flatnonzero(new)[1:] - 1, len(first) - 1]]
            keep_from, keep_to = np.r_[0, end], np.r_[begin, len(text)]
            kept = b"".join(text[a:b] for a, b in zip(keep_from.tolist(), keep_to.tolist()))
            results.append((kept, len(text), len(text) - len(kept), len(begin)))
        return pd.DataFrame(results, columns=["kept", "n_bytes", "n_removed", "n_spans"])

    found = (
        rows.select(ROW, *KEY, squeezed(F.col("data")).alias("squeezed"))
        .join(spans, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left")
        .select(ROW, cut("squeezed", "starts", "stops").alias("cut"))
    )
    results = {c: F.col(f"cut.{c}") for c in ("kept", "n_bytes", "n_removed", "n_spans")}
    return unpacked(found, own, **results)

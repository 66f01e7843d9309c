"""Packing of token sequences by minimum bin slack.

Full windows of a long document are sequences of their own, and what remains of each document is
shorter than a window. So there are fewer lengths than a window has tokens, whatever the number of
documents, and the whole packing is planned on their counts: the longest length left and the
multiset of others that comes closest to the window, found by a subset-sum dynamic program over
bitsets whose stages are walked back to counts, make a pattern, which is used as often as the
counts allow. Slack that no multiset fills is filled by the beginning of a document cut in two, whose
rest goes back into the counts. Every document gets a rank within its length from counts per
partition, and the plan says by length and rank which piece goes where.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tablework.workspace import checkpointed

CAPACITY = 2048
#: Bytes of ids that a task gives away at a time.
OUTPUT_BYTES = 1 << 23


class Run(NamedTuple):
    """Documents of one length, ``first`` <= rank < ``end``, of which ``start`` tokens are placed."""

    length: int
    first: int
    end: int
    start: int


class Slots(NamedTuple):
    """Where the next ``size`` tokens of a run's documents go.

    The run's i-th document takes slot ``i + skipped``, and ``per_sequence`` slots make a sequence.
    """

    run: Run
    size: int
    skipped: int
    per_sequence: int
    sequence: int
    offset: int

    def place(self, rank: int) -> tuple[int, int, int, int]:
        """``start, size, sequence, offset`` of the piece of the document with this rank."""
        at, slot = divmod(rank - self.run.first + self.skipped, self.per_sequence)
        return self.run.start, self.size, self.sequence + at, self.offset + slot * self.size


def closest_multiset(counts: dict[int, int], target: int) -> dict[int, int]:
    """The multiset of lengths, none used more often than counted, with the largest sum up to ``target``.

    Longer lengths come first, and the search ends once the target is reached. Stage i is a bitset
    of the sums that the first i lengths reach.
    """
    stages, lengths, reached, whole = [1], [], 1, (1 << target + 1) - 1
    for length in sorted(counts, reverse=True):
        if length > target:
            continue
        left, step = min(counts[length], target // length), 1
        while left:
            step = min(step, left)
            reached |= reached << step * length & whole
            left -= step
            step *= 2
        lengths.append(length)
        stages.append(reached)
        if reached >> target:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, before in zip(reversed(lengths), reversed(stages[:-1])):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            chosen[length] = n
    return chosen


class Plan:
    """The packing of ``counts`` documents per length, shorter than ``capacity`` all."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.counts = {length: n for length, n in counts.items() if n and length}
        self.runs = {length: deque([Run(length, 0, n, 0)]) for length, n in self.counts.items()}
        self.slots: list[Slots] = []
        self.n_sequences = 0
        while self.counts:
            self.fill()

    def take(self, length: int, size: int, n: int, per_sequence: int, offset: int) -> None:
        """Place the next ``size`` tokens of ``n`` documents that have ``length`` left."""
        runs, skipped = self.runs[length], 0
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
        while skipped < n:
            run = runs.popleft()
            end = min(run.end, run.first + n - skipped)
            taken = run._replace(end=end)
            if end < run.end:
                runs.appendleft(run._replace(first=end))
            self.slots.append(Slots(taken, size, skipped, per_sequence, self.n_sequences, offset))
            skipped += end - run.first
            if size < length:
                rest = length - size
                self.runs.setdefault(rest, deque()).append(taken._replace(start=run.start + size))
                self.counts[rest] = self.counts.get(rest, 0) + end - run.first

    def fill(self) -> None:
        """The next pattern, as often as the counts allow."""
        longest = max(self.counts)
        others = self.counts | {longest: self.counts[longest] - 1}
        pattern = closest_multiset(others, self.capacity - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        slack = self.capacity - sum(length * n for length, n in pattern.items())
        times = min(self.counts[length] // n for length, n in pattern.items())
        cut = None
        if slack:
            left = [x for x, n in self.counts.items() if n > pattern.get(x, 0)]
            if not left:
                self.finish()
                return
            cut = max(left)  # longer than the slack, or the multiset would hold it
            times = min(times, self.counts[cut] // (pattern.get(cut, 0) + 1))
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            self.take(length, length, n * times, n, offset)
            offset += length * n
        if cut is not None:
            self.take(cut, slack, times, 1, offset)
        self.n_sequences += times

    def finish(self) -> None:
        """The last documents, less than a window: sequences whose sizes are powers of two."""
        total = sum(length * n for length, n in self.counts.items())
        room = size = 0
        while self.counts:
            if not room:
                self.n_sequences += size > 0
                size = room = 1 << (total.bit_length() - 1)
            length = max(self.counts)
            piece = min(length, room)
            self.take(length, piece, 1, 1, size - room)
            room -= piece
            total -= piece
        self.n_sequences += 1

    def lookup(self) -> dict[int, tuple[list[int], list[list[Slots]]]]:
        """Per length the ranks at which the places change, and the slots from each on."""
        by_length: dict[int, list[Slots]] = {}
        for slots in self.slots:
            by_length.setdefault(slots.run.length, []).append(slots)
        found = {}
        for length, group in by_length.items():
            edges = sorted({slots.run.first for slots in group})
            covering: list[list[Slots]] = [[] for _ in edges]
            for slots in group:
                at = bisect_right(edges, slots.run.first) - 1
                while at < len(edges) and edges[at] < slots.run.end:
                    covering[at].append(slots)
                    at += 1
            found[length] = edges, covering
        return found


@lru_cache(maxsize=2)
def byte_pair_encoder(path: str, pattern: str, end_of_text: str) -> Callable[[str], list[int]]:
    """The ids of a text by a file of ranks; the name of the end of text is its own id."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {end_of_text: len(ranks)}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
    )
    return lambda text: encoding.encode(text, allowed_special=set(special))


def encoded(
    df: DataFrame, encoder: Callable[[], Callable[[str], list[int]]], end_id: int, capacity: int
) -> DataFrame:
    """``doc_id, ids, n_tokens, remainder, part, rank, full``: documents in their partitions.

    ``rank`` counts the documents of the same remainder before it in the partition, ``full`` the
    full windows there. Both are bounded state, and the written rows keep them together.
    """
    schema = StructType(
        [df.schema["doc_id"], StructField("ids", BinaryType())]
        + [StructField(name, LongType()) for name in ("n_tokens", "remainder", "part", "rank", "full")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        part = TaskContext.get().partitionId()
        ranks, full = np.zeros(capacity, np.int64), 0
        for batch in batches:
            n = batch.num_rows
            ids, numbers = [], np.empty((5, n), np.int64)
            for at, text in enumerate(batch.column("text")):
                tokens = np.array(encode(text.as_py() or "") + [end_id], "<u4")
                remainder = len(tokens) % capacity
                numbers[:, at] = len(tokens), remainder, part, ranks[remainder], full
                ranks[remainder] += 1
                full += len(tokens) // capacity
                ids.append(tokens.tobytes())
            arrays = [batch.column("doc_id"), pa.array(ids, pa.binary()), *map(pa.array, numbers)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return df.mapInArrow(run, schema)


def pack_documents(
    df: DataFrame,
    encoder: Callable[[], Callable[[str], list[int]]],
    end_id: int,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: one row per piece.

    A document is the ids of its whole text by ``encoder()``, which runs in the tasks, and
    ``end_id``; a null or empty text is ``end_id`` alone. Each id lies in exactly one piece, ``ids``
    are little-endian unsigned 32-bit integers, ``start`` counts the document's ids before the
    piece and ``offset`` the ids before it in its sequence. All sequences hold ``capacity`` ids, but
    for the last ones, whose sizes are different powers of two. A document is cut at full windows,
    and elsewhere only where no multiset of whole remainders fills a sequence.

    Every row is a document of its own, repeated rows and ids and null ids included. Other columns
    stay out, and an empty table gives an empty result. Equal lengths are ties: by partition and
    place in it. Texts are encoded once and written; the driver sees one count per length, at most
    ``capacity``, and sends out the plan, which they bound.
    """
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    docs = checkpointed(encoded(texts, encoder, end_id, capacity), "encoded")
    # Numbers of the documents per remainder, and of full windows, in each partition.
    counts = checkpointed(
        docs.groupBy("part", "remainder").agg(
            F.count("*").alias("n"), F.sum("n_tokens").alias("tokens")
        ),
        "remainders",
    )
    totals = counts.groupBy("remainder").agg(F.sum("n").alias("n")).collect()
    plan = Plan({row.remainder: row.n for row in totals}, capacity)
    places, n_planned = plan.lookup(), plan.n_sequences

    earlier = Window.partitionBy("remainder").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    ranks = counts.select("part", "remainder", before.alias("ranks_before"))
    full = counts.groupBy("part").agg(
        F.expr(f"sum(tokens - remainder * n) div {capacity}").alias("n"),
        F.lit("full").alias("remainder"),
    ).select("part", before.alias("full_before"))
    numbered = docs.join(ranks, ["part", "remainder"]).join(full, "part").select(
        "doc_id",
        "ids",
        "remainder",
        (F.col("rank") + F.col("ranks_before")).alias("rank"),
        (F.col("full") + F.col("full_before") + n_planned).alias("full"),
    )

    def pieces(n: int, remainder: int, rank: int, full: int) -> Iterator[tuple[int, int, int, int]]:
        whole = n - remainder
        for window in range(whole // capacity):
            yield window * capacity, capacity, full + window, 0
        if remainder:
            edges, slots = places[remainder]
            for slot in slots[bisect_right(edges, rank) - 1]:
                start, size, sequence, offset = slot.place(rank)
                yield whole + start, size, sequence, offset

    longs = [StructField(name, LongType()) for name in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    longs.insert(2, StructField("ids", BinaryType()))
    schema = StructType([StructField("doc_id", df.schema[id_col].dataType), *longs])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            rows, size = [], 0

            def block() -> pa.RecordBatch:
                at, *columns = map(list, zip(*rows))
                arrays = [doc_ids.take(pa.array(at)), *map(pa.array, columns[:2])]
                arrays += [pa.array(columns[2], pa.binary()), *map(pa.array, columns[3:])]
                return pa.RecordBatch.from_arrays(arrays, schema.names)

            numbers = zip(*(batch.column(name).to_pylist() for name in ("remainder", "rank", "full")))
            for at, (ids, row) in enumerate(zip(batch.column("ids"), numbers)):
                data = ids.as_buffer()
                n = data.size // 4
                for start, length, sequence, offset in pieces(n, *row):
                    part = data[4 * start : 4 * (start + length)].to_pybytes()
                    rows.append((at, start, length, part, n, sequence, offset))
                    size += len(part)
                    if size >= OUTPUT_BYTES:
                        yield block()
                        rows, size = [], 0
            if rows:
                yield block()

    return numbered.mapInArrow(cut, schema)

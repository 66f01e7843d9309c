"""An attempt at op4's dealt method: transforms of shards, merged by refining their interleave.

python tests/llm/merge_attempt.py [SF_DIR] [ROUNDS] [SHARD_BYTES]

Each shard of texts gets its own order of rotations, compared over 256 bytes, and the symbols
before them. The interleave starts as shard after shard; a round sorts it stably by the symbol that
each entry's shard has next. After r rounds it is ordered by r symbols. Prints what a round costs.
"""

import sys
import time
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablework.session import build_session
from tablework.workspace import checkpointed

CHUNK = 1 << 20


def rotations(data: np.ndarray) -> np.ndarray:
    """Order of all rotations by their first 256 bytes, by doubling."""
    rank, step = data.astype(np.int64), 1
    while True:
        key = rank * (len(data) + 256) + np.roll(rank, -step) if step < 256 else rank
        order = np.argsort(key, kind="stable")
        if step >= 256:
            return order
        rank = np.empty_like(order)
        rank[order] = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
        step *= 2


def transform(batches):
    for batch in batches:
        for shard, text in zip(batch["shard"], batch["data"]):
            data, start = np.frombuffer(text, np.uint8), time.process_time()
            order = rotations(data)
            yield pd.DataFrame({"shard": [shard], "n": len(data), "symbols": [data[order - 1].tobytes()],
                                "order": [order.astype(np.int32).tobytes()],
                                "cpu": time.process_time() - start})


def cut_at_chunks(offset: int, data: bytes):
    while data:
        size = CHUNK - offset % CHUNK
        yield offset // CHUNK, offset, data[:size]
        offset, data = offset + size, data[size:]


def gathered(pieces):
    """``chunk, z`` from pieces ``chunk, offset, data``."""
    join = lambda g: pd.DataFrame({"chunk": g["chunk"].iloc[:1], "z": [b"".join(g.sort_values("offset")["data"])]})
    return pieces.groupBy("chunk").applyInPandas(join, "chunk long, z binary")


def refined(shards, z, n_shards: int):
    """The interleave after one more symbol, and the bytes that travelled for it."""
    count = F.udf(lambda data: np.bincount(np.frombuffer(data, np.uint8), minlength=n_shards).tolist(), "array<long>")
    counts = np.array([row[1] for row in sorted(z.select("chunk", count("z")).collect())])
    edges = np.vstack([np.zeros(n_shards, np.int64), np.cumsum(counts, axis=0)])

    def slices(batches):
        for batch in batches:
            for shard, symbols in zip(batch["shard"], batch["symbols"]):
                for chunk in range(len(counts)):
                    part = symbols[edges[chunk, shard] : edges[chunk + 1, shard]]
                    if part:
                        yield pd.DataFrame({"chunk": [chunk], "shard": shard, "part": [part]})

    def sort(left, right):
        entries = np.frombuffer(left["z"].iloc[0], np.uint8)
        symbols = np.empty(len(entries), np.uint8)
        for shard, part in zip(right["shard"], right["part"]):
            symbols[entries == shard] = np.frombuffer(part, np.uint8)
        entries = entries[np.argsort(symbols, kind="stable")]
        sizes = np.bincount(symbols, minlength=256)
        stops = np.cumsum(sizes)
        present = np.flatnonzero(sizes)
        return pd.DataFrame({"symbol": present, "chunk": left["chunk"].iloc[0], "n": sizes[present],
                             "data": [entries[stops[s] - sizes[s] : stops[s]].tobytes() for s in present]})

    parts = shards.select("shard", "symbols").mapInPandas(slices, "chunk long, shard int, part binary")
    runs = checkpointed(
        z.groupBy("chunk").cogroup(parts.groupBy("chunk")).applyInPandas(sort, "symbol int, chunk long, n long, data binary"), "runs"
    )
    places, at = defaultdict(dict), 0
    for symbol, chunk, n in sorted(map(tuple, runs.select("symbol", "chunk", "n").collect())):
        places[symbol][chunk], at = at, at + n

    def cut(batches):
        for batch in batches:
            rows = [piece for row in batch.itertuples() for piece in cut_at_chunks(places[row.symbol][row.chunk], row.data)]
            yield pd.DataFrame(rows, columns=["chunk", "offset", "data"])

    return checkpointed(gathered(runs.mapInPandas(cut, "chunk long, offset long, data binary")), "interleave")


def is_ordered(shards, z, texts: dict, rounds: int) -> bool:
    entries = np.frombuffer(b"".join(row["z"] for row in sorted(z.collect())), np.uint8)
    prefixes = np.empty((len(entries), rounds), np.uint8)
    for row in shards.select("shard", "order").collect():
        data, order = np.frombuffer(texts[row["shard"]], np.uint8), np.frombuffer(row["order"], np.int32)
        prefixes[entries == row["shard"]] = np.take(data, order[:, None] + np.arange(rounds), mode="wrap")
    keys = [bytes(prefix) for prefix in prefixes]
    return all(a <= b for a, b in zip(keys, keys[1:]))


def main(sf_dir: str = "/root/testdata/sf0.01", rounds: str = "5", shard_bytes: str = "1000000") -> None:
    spark = build_session("attempt", "local[8]", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("OFF")
    texts, size = defaultdict(bytes), 0
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").toLocalIterator():
        data = (row["text"] or "").encode() + b"\0"
        texts[size // int(shard_bytes)] += data
        size += len(data)
    start = time.time()
    rows = spark.createDataFrame(list(texts.items()), "shard int, data binary").repartition(8)
    shards = checkpointed(rows.mapInPandas(transform, "shard int, n long, symbols binary, order binary, cpu double"), "transforms")
    cpu = shards.agg(F.sum("cpu")).first()[0]
    print(f"{size} bytes, {len(texts)} shards: transforms {time.time() - start:.1f} s, {cpu:.1f} CPU s", flush=True)
    pieces, at = [], 0
    for shard in sorted(texts):
        pieces += cut_at_chunks(at, bytes([shard]) * len(texts[shard]))
        at += len(texts[shard])
    z = checkpointed(gathered(spark.createDataFrame(pieces, "chunk long, offset long, data binary")), "interleave")
    for number in range(int(rounds)):
        start = time.time()
        z = refined(shards, z, len(texts))
        print(f"round {number + 1}: {time.time() - start:.2f} s", flush=True)
    if size < 10_000_000:
        print("ordered by", rounds, "symbols:", is_ordered(shards, z, texts, int(rounds)))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])

"""Packing against the tokenizers library, every id in one place, and all multisets."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.llm.packing import Plan, closest_multiset, pack_documents
from tablework.llm.queries import byte_pair_ids, op12_packing


@pytest.fixture(scope="module")
def ids_of():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_closest_multiset_against_all():
    dice = random.Random(3)
    for _ in range(200):
        counts = {dice.randrange(1, 30): dice.randrange(4) for _ in range(5)}
        target = dice.randrange(60)
        found = closest_multiset(counts, target)
        assert all(0 < n <= counts[length] for length, n in found.items())
        sums = [
            sum(length * n for length, n in zip(counts, ns))
            for ns in itertools.product(*(range(n + 1) for n in counts.values()))
        ]
        assert sum(length * n for length, n in found.items()) == max(s for s in sums if s <= target)


def check_plan(counts, capacity):
    plan = Plan(dict(counts), capacity)
    places = plan.lookup()
    sequences = {}
    for length, n in counts.items():
        edges, covering = places[length]
        for rank in range(n):
            at = max(i for i, edge in enumerate(edges) if edge <= rank)
            pieces = sorted(slots.place(rank) for slots in covering[at])
            assert [p[0] for p in pieces] == [0, *itertools.accumulate(p[1] for p in pieces)][:-1]
            assert sum(p[1] for p in pieces) == length
            for _, size, sequence, offset in pieces:
                sequences.setdefault(sequence, []).append((offset, size))
    assert sorted(sequences) == list(range(plan.n_sequences))
    return plan, check_sequences(sequences, capacity)


def check_sequences(sequences, capacity):
    """No gaps, and all full but the last ones of different powers of two."""
    sizes = []
    for pieces in sequences.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [0, *itertools.accumulate(p[1] for p in pieces)][:-1]
        sizes.append(sum(p[1] for p in pieces))
    short = [size for size in sizes if size != capacity]
    assert all(size & (size - 1) == 0 for size in short) and len(set(short)) == len(short)
    return sizes


@pytest.mark.parametrize("seed", range(12))
def test_plans_place_everything_once(seed):
    dice = random.Random(seed)
    capacity = dice.choice([16, 64, 100])
    lengths = dice.sample(range(1, capacity), dice.choice([1, 2, 9]))
    check_plan({length: dice.randrange(1, 90) for length in lengths}, capacity)


def test_plans_of_huge_counts_stay_small():
    dice = random.Random(5)
    for counts in (
        {length: dice.randrange(10**9) for length in range(1, 2048)},
        {1500: 10**12 + 7, 1: 3, 2047: 10**11},
        {1: 10**10},
    ):
        total = sum(length * n for length, n in counts.items())
        plan = Plan(counts, 2048)
        assert len(plan.slots) < 20_000
        assert total // 2048 <= plan.n_sequences <= total // 2048 + 11


def check_packing(rows, texts, ids_of, capacity=2048):
    """Every row's ids come back, and padding is nowhere needed."""
    documents, sequences = {}, {}
    for row in rows:
        documents.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    check_sequences(sequences, capacity)
    assert set(documents) == {doc_id for doc_id, _ in texts}
    for doc_id, group in itertools.groupby(sorted(texts, key=str), key=lambda pair: pair[0]):
        wanted = sorted((ids_of(text) for _, text in group), key=len)
        ends = 0
        for row in documents[doc_id]:
            assert any(
                len(ids) == row.doc_tokens and zlib.crc32(
                    np.array(ids[row.start : row.start + row.length], "<u4").tobytes()
                ) == row.ids_crc32
                for ids in wanted
            )
            ends += row.length
        assert ends == sum(map(len, wanted))


def test_given_documents(spark, sf_dir, given_docs, ids_of):
    packed = op12_packing(spark, sf_dir)
    assert packed.columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]
    texts = [tuple(row) for row in given_docs.select("doc_id", "text").collect()]
    check_packing(packed.collect(), texts, ids_of)


def test_odd_documents(spark, odd_docs, odd_rows, ids_of):
    packed = pack_documents(odd_docs, byte_pair_ids(), 1).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(packed.collect(), [row[:2] for row in odd_rows], ids_of)


def test_small_windows_and_no_documents(spark, odd_docs, no_docs, ids_of):
    short = odd_docs.where("char_length(text) < 100 or text is null")
    packed = pack_documents(short, byte_pair_ids(), 1, capacity=24).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(packed.collect(), [tuple(r) for r in short.select("doc_id", "text").collect()], ids_of, 24)
    assert pack_documents(no_docs, byte_pair_ids(), 1).count() == 0


def test_ids_are_those_of_the_other_library(ids_of):
    encode = byte_pair_ids()()
    dice = random.Random(2)
    odd = "<|endoftext|> \n\t'sé日😀\u0000​٣Ⅷ²a1._"
    for _ in range(300):
        text = "".join(dice.choices([odd[:13], *odd[13:]], k=dice.randrange(60)))
        assert encode(text) + [1] == ids_of(text)

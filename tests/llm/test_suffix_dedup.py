"""Repeated byte strings against a count of all strings."""

import random
from collections import Counter

import numpy as np
import pytest

from tablework.llm.suffix_dedup import anchor_leads, remove_repeats


def expected(rows, length):
    texts = [(text or "").encode() for _, text in rows]
    starts = Counter(text[i : i + length] for text in texts for i in range(len(text) - length + 1))
    result = []
    for (doc_id, _), text in zip(rows, texts):
        covered = np.zeros(len(text) + 1, int)
        for i in range(len(text) - length + 1):
            if starts[text[i : i + length]] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        gone = np.cumsum(covered)[:-1] > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        result.append((doc_id, kept, len(text), int(gone.sum()), spans))
    return sorted(result, key=str)


def got(docs, **options):
    found = remove_repeats(docs, **options).select("doc_id", "kept", "n_bytes", "n_removed", "n_spans")
    return sorted(((r[0], bytes(r[1]), *r[2:]) for r in found.collect()), key=str)


@pytest.mark.parametrize(
    "length, spread, gram, letters, crowd",
    [(12, 8, 3, "ab", 20_000), (12, 8, 3, "ab", 1), (20, 8, 4, "abc \0é", 20_000), (24, 16, 9, "a", 5)],
)
def test_random_passages(spark, length, spread, gram, letters, crowd):
    pick = random.Random(length * crowd)
    pool = ["".join(pick.choice(letters) for _ in range(pick.randint(5, 60))) for _ in range(10)]
    texts = [
        "".join(pick.choice(pool)[: pick.randint(1, 60)] + pick.choice(letters) for _ in range(pick.randint(0, 5)))
        for _ in range(40)
    ]
    rows = list(enumerate([None, "", "a" * 90, *texts, texts[7]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    options = {"length": length, "spread": spread, "gram": gram, "crowd": crowd}
    assert got(docs, **options) == expected(rows, length)


def test_odd_rows(odd_docs, odd_rows, keeps_columns):
    assert got(odd_docs) == expected([row[:2] for row in odd_rows], 200)
    keeps_columns(odd_docs.drop("text"), remove_repeats(odd_docs), "kept", "n_bytes")


def test_given_documents(given_docs):
    rows = [tuple(row) for row in given_docs.select("doc_id", "text").collect()]
    assert got(given_docs) == expected(rows, 200)


def test_no_rows(no_docs):
    assert got(no_docs) == []


def test_equal_strings_have_equal_anchors():
    text = np.frombuffer(random.Random(1).randbytes(4000) * 2, np.uint8)
    leads = anchor_leads(text, 128, 16)
    assert (leads[:3800] == leads[4000:7800]).all() and leads.max() < 128

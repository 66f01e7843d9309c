"""Fingerprints and their components against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from tablework.llm import simhash
from tablework.llm.graph import component_roots
from tablework.llm.simhash import CodeTree, link_codes, near_duplicates, one_of_each_group, text_fingerprint


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [word for word in re.split(r"[\x20\x09-\x0D]+", lower) if word]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(codes):
    """The smallest index reachable from each code."""
    codes = np.array(codes, np.uint64)
    labels = np.arange(len(codes))
    while True:
        before = labels.copy()
        for i in range(len(codes)):
            near = np.bitwise_count(codes ^ codes[i]) <= 2
            labels[near] = labels[near].min()
        if (labels == before).all():
            return labels.tolist()


@pytest.fixture(scope="module")
def codes():
    """A chain of near codes, a crowd around one code, and scattered ones."""
    random = np.random.default_rng(7)
    chain = [int(random.integers(0, 2**63))]
    for i in range(40):
        chain.append(chain[-1] ^ (1 << int(random.integers(0, 64))) ^ (1 << int(random.integers(0, 64))))
    center = int(random.integers(0, 2**63))
    crowd = {center ^ (1 << a) ^ (1 << b) for a in range(0, 24) for b in range(a, 24)}
    scattered = [int(code) for code in random.integers(0, 2**63, 200)]
    return sorted({*chain, *crowd, *scattered, 0, 2**64 - 1, 2**64 - 2})


def test_tree_finds_all_within_two_bits(codes):
    array = np.array(codes, np.uint64)
    for other in (array, array[:3], array[5:300]):
        near = np.bitwise_count(array[:, None] ^ other[None, :]) <= 2
        expected = {(int(a), int(b)) for a, b in zip(*np.nonzero(near))}
        for one, two, turned in ((array, other, False), (other, array, True)):
            blocks = list(CodeTree(one).near(CodeTree(two), 2))
            got = [(int(a), int(b)) for x, y in blocks for a, b in zip(x, y)]
            got = [(b, a) for a, b in got] if turned else got
            assert len(got) == len(set(got)) and set(got) == expected


def rank(code):
    for shift in (1, 2, 4, 8, 16, 32):
        code ^= code >> shift
    return code


def test_leaves_are_in_gray_order(spark, codes, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 9)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(code,) for code in signed], "code long").repartition(4)
    leaves = simhash.gray_leaves(df).orderBy("number").collect()
    assert [row["number"] for row in leaves] == list(range(len(leaves)))
    assert all(len(row["codes"]) <= 9 for row in leaves)
    order = [code % 2**64 for row in leaves for code in row["codes"]]
    half = 2**63  # negative ranks, the second half, come first
    assert order == sorted(codes, key=lambda code: (rank(code) + half) % 2**64)
    for row in leaves:
        assert row["low"] == np.bitwise_and.reduce(row["codes"])
        assert row["high"] == np.bitwise_or.reduce(row["codes"])


@pytest.mark.parametrize("limit", [0, 1, 2, 5])
def test_pairs_of_leaves_hold_all_near_pairs(spark, codes, monkeypatch, limit):
    """Three levels above the leaves: nothing near is passed over, and most of the rest is."""
    monkeypatch.setattr(simhash, "LEAF", 2)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(code,) for code in signed], "code long").repartition(4)
    leaves = simhash.gray_leaves(df)
    pairs = {tuple(row) for row in simhash.near_leaves(leaves, limit).collect()}
    of = {code % 2**64: row["number"] for row in leaves.collect() for code in row["codes"]}
    array = np.array(codes, np.uint64)
    near = np.nonzero(np.bitwise_count(array[:, None] ^ array[None, :]) <= limit)
    needed = {tuple(sorted((of[codes[a]], of[codes[b]]))) for a, b in zip(*near)}
    n = len(set(of.values()))
    assert n > 250 and needed <= pairs and all(x <= y for x, y in pairs)
    assert limit > 2 or len(pairs) < n * n / 4


def test_the_tree_finds_what_brute_force_finds(spark, given_docs, monkeypatch):
    """Given documents: as many near pairs below the pairs of leaves as among all codes."""
    texts = [row["text"] for row in given_docs.select("text").collect()]
    own = np.array(sorted({text_fingerprint(text) % 2**64 for text in texts}), np.uint64)
    changed = np.concatenate([own, own ^ np.uint64(1 << 40), own ^ np.uint64(5)])
    array = np.unique(changed)
    df = spark.createDataFrame([(code,) for code in array.view(np.int64).tolist()], "code long")
    monkeypatch.setattr(simhash, "LEAF", 16)
    leaves = simhash.gray_leaves(df)
    held = {row["number"]: np.array(row["codes"], np.int64).view(np.uint64) for row in leaves.collect()}
    found = 0
    for x, y in simhash.near_leaves(leaves, 2).collect():
        for a, b in CodeTree(held[x]).near(CodeTree(held[y]), 2):
            found += int((a < b).sum()) if x == y else len(a)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 2
    assert found == (near.sum() - len(array)) // 2 > 0


@pytest.mark.parametrize("leaf", [5, 50, 2048])
def test_links_connect_what_is_near(spark, codes, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    links = link_codes(spark.createDataFrame([(code,) for code in signed], "code long").repartition(4))
    roots = {row["node"]: row["root"] for row in component_roots(links).collect()}
    label = {code: roots.get(code, code) for code in signed}
    expected = components(codes)
    groups = {}
    for code, root in zip(signed, expected):
        groups.setdefault(root, set()).add(label[code])
    assert all(len(found) == 1 for found in groups.values())
    assert len({next(iter(found)) for found in groups.values()}) == len(groups)


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, i) for i in range(1001, 1300)]
    links = spark.createDataFrame(chain + star + [(5, 5), (3, 2)], "a long, b long")
    roots = {row["node"]: row["root"] for row in component_roots(links).collect()}
    assert roots == {i: 0 for i in range(1, 101)} | {i: 1000 for i in range(1001, 1300)}
    assert component_roots(links.limit(0)).count() == 0


def check(docs):
    rows = [tuple(row) for row in docs.select("doc_id", "text").collect()]
    distinct = sorted({fingerprint(text) for _, text in rows})
    root = dict(zip(distinct, components(distinct)))
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            at = root[fingerprint(text)]
            first[at] = min(doc_id, first.get(at, doc_id))
    expected = sorted(
        ((doc_id, fingerprint(text), first.get(root[fingerprint(text)])) for doc_id, text in rows), key=str
    )
    found = near_duplicates(docs).collect()
    got = sorted(((r[0], r["code"] % 2**64, r["component_id"]) for r in found), key=str)
    assert got == expected
    return first


def test_given_documents(given_docs):
    check(given_docs)


def test_odd_rows(odd_docs, odd_rows, keeps_columns):
    first = check(odd_docs)
    kept = one_of_each_group(odd_docs)
    keeps_columns(odd_docs, kept)
    assert kept.columns == odd_docs.columns
    ids = [row["doc_id"] for row in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(first.values()))
    assert ids.count(None) == 2  # the rows without id are near nothing and near each other not


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).count() == one_of_each_group(no_docs).count() == 0


def test_long_and_blank_texts():
    for text in ("", " \n", "one", "one two", "A b C d", "w " * 70_000, None):
        assert text_fingerprint(text) % 2**64 == fingerprint(text)

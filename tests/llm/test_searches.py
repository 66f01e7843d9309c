"""Vector searches against all distances."""

import numpy as np
import pytest

from tablework.llm import neighbours, topk
from tablework.llm.neighbours import approximate_neighbours
from tablework.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label string, id string, size string, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "l", "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, every, k, score, best_low):
    valid = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    result = set()
    for q, x in valid.items():
        if q % every:
            continue
        found = [(score(x, y), i) for i, y in valid.items() if i != q and len(y) == len(x)]
        found.sort(key=lambda pair: (pair[0] if best_low else -pair[0], pair[1]))
        result |= {(q, rank, i, s) for rank, (s, i) in enumerate(found[:k], 1)}
    return result


def product(x, y):
    return int(np.floor(256 * x) @ np.floor(256 * y))


def distance(x, y):
    return float(np.sqrt(((x - y) ** 2).sum()))


@pytest.fixture(scope="module")
def odd_vectors():
    random = np.random.default_rng(4)
    rows = [(i, random.normal(size=16).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 16) for i in range(300, 500)]  # many copies, ties everywhere
    rows += [(i, random.normal(size=5).tolist()) for i in range(1000, 1030)]
    unusable = [(2000, None), (2050, []), (2100, [None] + [1.0] * 15), (None, [1.0] * 16)]
    unusable += [(2150, [float("nan")] + [1.0] * 15), (2200, [float("inf")] + [1.0] * 15)]
    return rows, unusable


def test_top_k_with_ties_and_odd_vectors(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rows, unusable = odd_vectors
    df = frame(spark, rows + unusable + rows[:60])  # some rows twice
    got = {tuple(row) for row in exact_top_k(df, every=50).collect()}
    assert got == brute(rows, 50, 5, product, False)


def test_bounds_hold_on_all_levels():
    random = np.random.default_rng(5)
    x, y = random.normal(size=(50, 64)) * 100, random.normal(size=(70, 64)) * 100
    exact = x @ y.T
    last = np.inf
    for count in topk.segment_counts(64):
        bound = topk.segment_statistics(x, count) @ topk.segment_statistics(y, count).T
        assert (bound >= exact - 1e-6).all()
        assert (bound - exact).mean() < last
        last = (bound - exact).mean()


def test_few_candidates_are_all_returned(spark):
    rows = [(0, [1.0, 2.0]), (7, [1.0, 1.0]), (100, [0.0, 3.0])]
    assert exact_top_k(frame(spark, rows)).count() == 4
    assert approximate_neighbours(frame(spark, rows)).count() == 4
    nothing = frame(spark, rows).limit(0)
    assert exact_top_k(nothing).count() == approximate_neighbours(nothing).count() == 0


def test_neighbours_of_given_vectors(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(row["vec_id"], row["embedding"]) for row in vectors.collect()]
    got = {tuple(row) for row in approximate_neighbours(vectors).collect()}
    expected = brute(rows, 100, 10, distance, True)
    assert {(q, rank) for q, rank, *_ in got} == {(q, rank) for q, rank, *_ in expected}
    pairs = {(q, i) for q, _, i, _ in expected}
    found = {(q, i): s for q, _, i, s in got}
    assert len(pairs & set(found)) >= 0.9 * len(pairs)
    exact = {(q, i): s for q, _, i, s in expected}
    assert all(found[pair] == pytest.approx(exact[pair], rel=1e-14) for pair in pairs & set(found))


def test_neighbours_with_odd_vectors_in_small_blocks(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", 20)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
    rows, unusable = odd_vectors
    df = frame(spark, rows + unusable + [(2300, [0.0] * 16)])
    got = {tuple(row)[:3] for row in approximate_neighbours(df).collect()}
    expected = {row[:3] for row in brute(rows, 100, 10, distance, True)}
    copies = {row for row in expected if row[0] in (300, 400)}
    assert copies <= got  # ties among copies go to the smaller ids
    pairs, found = {(q, i) for q, _, i in expected}, {(q, i) for q, _, i in got}
    assert len(found & pairs) >= 0.9 * len(pairs) and len(got) == len(expected)


def test_the_graph_reaches_every_centroid():
    random = np.random.default_rng(6)
    apart = np.concatenate([random.normal(size=(30, 8)), random.normal(size=(30, 8)) + 100])
    graph = neighbours.CentroidGraph(apart)
    known = graph.walk(apart, 1.0)
    assert (known.argmin(axis=1) == np.arange(60)).all()


def test_large_components_take_part(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    random = np.random.default_rng(9)
    rows = [(i, random.normal(size=16).tolist()) for i in range(200)]
    rows += [(i, (random.normal(size=16) * 2.0 ** (16 + (i - 200) // 12)).tolist()) for i in range(200, 260)]
    exact = lambda x, y: sum(int(a) * int(b) for a, b in zip(np.floor(256 * x), np.floor(256 * y)))
    assert sum(topk.is_large(topk.quantised(np.array([v for _, v in rows]), 256))) > 20
    got = {tuple(row) for row in exact_top_k(frame(spark, rows), every=50).collect()}
    assert got == brute(rows, 50, 5, exact, False)


def test_a_score_beyond_a_long_is_an_error(spark):
    rows = [(i, [2.0**40, 1.0, 1.0, 1.0]) for i in range(3)]
    with pytest.raises(Exception, match="OverflowError"):
        exact_top_k(frame(spark, rows), every=2).collect()

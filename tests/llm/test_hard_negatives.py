"""Hard negatives against all scores."""

import numpy as np
import pytest

from tablework.llm import hard_negatives
from tablework.llm.hard_negatives import mine_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label long, row string, anchor string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA).repartition(3)


def brute(rows, every):
    whole = [(i, [int(x) for x in np.floor(256 * np.array(v, np.float32).astype(float))], label)
             for i, v, label in rows]
    result = []
    for at, (q, x, label) in enumerate(whole):
        if q % every:
            continue
        scores = [
            (-sum(a * b for a, b in zip(x, y)), i, other)
            for place, (i, y, other) in enumerate(whole) if place != at and len(y) == len(x)
        ]
        scores.sort(key=lambda score: score[:2])
        for p, positive, _ in [score for score in scores if score[2] == label][:5]:
            fits = [s for s in scores if s[2] != label and -30 * p <= -100 * s[0] <= -90 * p][:10]
            result += [(q, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(fits, 1)]
    return sorted(result)


def got(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def odd_vectors():
    dice = np.random.default_rng(8)
    middles = dice.normal(size=(4, 16))
    rows = [
        (i, (middles[i % 4] + dice.normal(size=16) * 0.7).tolist(), int(dice.integers(3)))
        for i in range(400)
    ]
    rows += [(i, [0.5] * 16, i % 2) for i in range(400, 480)]  # copies: ties everywhere
    rows += [(500 + i, dice.normal(size=70).tolist(), i % 3) for i in range(41)]
    rows += [(600 + i, [0.0] * 16, i % 2) for i in range(30)]
    rows += rows[:30] + [(20, [1.0] * 16, 1)]  # rows twice, and an id with another vector
    return rows


UNUSABLE = [
    (700, None, 1), (720, [], 1), (740, [None] + [1.0] * 15, 1), (None, [1.0] * 16, 1),
    (760, [float("nan")] + [1.0] * 15, 1), (780, [float("-inf")] + [1.0] * 15, 1), (800, [1.0] * 16, None),
]


def test_odd_vectors_in_small_blocks(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_COMPONENTS", 2000)
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", 20)
    found = mine_hard_negatives(frame(spark, odd_vectors + UNUSABLE), every=20)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    assert got(found) == brute(odd_vectors, 20)


def test_few_rows_and_none(spark, odd_vectors):
    few = odd_vectors[:9]
    assert got(mine_hard_negatives(frame(spark, few), every=2)) == brute(few, 2)
    assert mine_hard_negatives(frame(spark, few).limit(0)).count() == 0


def test_large_components(spark):
    dice = np.random.default_rng(9)
    rows = [(i, (dice.normal(size=6) * 4.0 ** (i % 10)).tolist(), i % 2) for i in range(150)]
    rows += [(i, (dice.normal(size=6) * 2.0**21).tolist(), i % 2) for i in range(150, 190)]
    whole = hard_negatives.quantised(np.array([row[1] for row in rows]), 256)
    assert 5 < hard_negatives.is_large(whole).sum() < 60
    assert got(mine_hard_negatives(frame(spark, rows), every=10)) == brute(rows, 10)


def test_a_score_beyond_a_long_is_an_error(spark):
    rows = [(i, [2.0**40, 1.0, 1.0], i % 2) for i in range(4)]
    with pytest.raises(Exception, match="OverflowError"):
        mine_hard_negatives(frame(spark, rows), every=2).collect()


@pytest.mark.parametrize("size", [1, 3, 64, 130])
def test_intervals_hold_the_scores_and_close_on_codes(size):
    dice = np.random.default_rng(size)
    x, y = np.floor(dice.normal(size=(30, size)) * 100), np.floor(dice.normal(size=(50, size)) * 100)
    codes, alignment, norm = hard_negatives.one_bit_codes(y)
    ones = np.bitwise_count(codes).sum(axis=1).astype(float)
    residual = np.sqrt(np.maximum(norm**2 - alignment**2, 0))
    low, high = hard_negatives.RoundedQueries(x).intervals(
        slice(0, 30), codes, ones, alignment, norm, residual
    )
    assert (low <= x @ y.T).all() and (x @ y.T <= high).all()
    # A vector that is its code's direction has no residual: only rounding is left.
    signs = np.where(dice.normal(size=(50, size)) > 0, 1.0, -1.0) @ hard_negatives.rotation(size).T
    codes, alignment, norm = hard_negatives.one_bit_codes(signs)
    assert alignment == pytest.approx(norm)


def test_limits_are_exact():
    scores = np.array([0, 1, 9, 10, 99, 100, 101, 12345, 2**62 - 1])
    low, high = hard_negatives.limits(scores, (30, 90))
    for p, a, b in zip(scores.tolist(), low.tolist(), high.tolist()):
        assert 100 * (a - 1) < 30 * p <= 100 * a and 100 * b <= 90 * p < 100 * (b + 1)

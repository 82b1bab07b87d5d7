"""Threshold search against brute force; odd rows; blocks and chunks."""

import math
import random

import numpy as np
import pytest

from corpusloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score int, v string, dim int, block string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 3, "y") for r in rows], SCHEMA)


def brute(rows, every, positives, negatives, low, high):
    """One row per id, as the docstring says; then all pairs."""
    kept = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, row), row)
    out = set()
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = [
            (-sum(p * q for p, q in zip(v, w)), b, other)
            for b, (other, w) in kept.items() if b != a and len(w) == len(v)
        ]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [(n, b) for n, b, other in scored if other != label and low * -s <= 100 * -n <= high * -s]
            out |= {(a, p, i + 1, b, -s, -n) for i, (n, b) in enumerate(fit[:negatives])}
    return out


def mined(spark, rows, every=5, **sizes):
    found = hn.mine(hn.integer_rows(table(spark, rows)), every=every, positives=3, negatives=4, **sizes)
    return [tuple(r) for r in found.collect()]


def random_rows(seed, n=160, dims=4):
    rng = random.Random(seed)
    # Few values, so that scores tie; every third row is one and the same vector.
    pick = lambda i: [0.5] * dims if i % 3 == 0 else [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(dims)]
    return [(i, pick(i), rng.randrange(3)) for i in range(-20, n)]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 20, "chunk_anchors": 7}])
def test_equals_brute_force(spark, sizes):
    rows = random_rows(3)
    got = mined(spark, rows, **sizes)
    assert len(got) == len(set(got)) > 100
    assert set(got) == brute(rows, 5, 3, 4, 30, 90)


def test_odd_rows(spark):
    rows = [
        (0, [0.5, 0.5], 1), (0, [0.5, 0.5], 1), (5, [1.0, 0.5], 1), (5, [1.0, 0.5], 0), (None, [9.0, 9.0], 1),
        (7, None, 1), (8, [None, 1.0], 1), (9, [float("nan"), 1.0], 1), (10, [float("inf"), 1.0], 1),
        (11, [0.25, 0.25], None), (12, [0.25, 0.25], 2), (13, [0.25, 0.25], 2), (14, [], 1), (15, [], 1), (16, [], 2),
        (17, [0.5], 1), (18, [0.25, 0.5], 1), (20, [0.0, 0.0], 1), (21, [-0.5, 0.5], 2), (25, [3e30, 1.0], 2),
    ]
    got = mined(spark, rows)
    small = [r for r in rows if r[0] != 25]
    # The row whose components pass a long: scores saturate, and it takes no smaller row's place.
    assert {r for r in got if 25 not in (r[0], r[1], r[3])} == {
        r for r in brute(small, 5, 3, 4, 30, 90) if r[0] != 25
    }


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, None, None)]) == []


def test_search_stops_early_and_is_exact():
    rng = np.random.default_rng(5)
    # One strong dimension: the lists show the best rows first.
    x = np.concatenate([rng.integers(-1000, 1000, (4000, 1)), rng.integers(-3, 3, (4000, 3))], 1)
    block = hn.Block(np.arange(4000), np.zeros(4000, np.int64), x)
    anchor = np.array([100, 1, -1, 0])
    scores = x @ anchor
    want = sorted(zip(-scores, np.arange(4000)))[:5]
    ids, got = block.positives(-1, 0, anchor, 5)
    assert [(-s, i) for i, s in zip(ids, got)] == want

    kth = -want[-1][0]
    rows, _, depth = block.search(anchor, lambda r, s, t: t < kth)
    assert depth < 200 and {i for _, i in want} <= set(rows.tolist())


def test_ties_at_the_threshold_are_all_read():
    # All rows score the same: the threshold never falls strictly below, so the smallest ids win.
    ids = np.arange(100)[::-1].copy()
    block = hn.Block(ids, np.ones(100, np.int64), np.ones((100, 2), np.int64))
    found, _ = block.positives(-1, 1, np.array([1, 1]), 3)
    assert found.tolist() == [0, 1, 2]
    (inside, _), = block.negatives(0, np.array([1, 1]), [(2, 2)], 3)
    assert inside.tolist() == [0, 1, 2]


def test_large_components_are_exact():
    big = 1 << 40
    block = hn.Block(np.arange(3), np.zeros(3, np.int64), np.array([[big, 1], [big, 2], [big, 3]]))
    ids, scores = block.positives(-1, 0, np.array([1 << 20, 1]), 2)
    assert ids.tolist() == [2, 1] and scores.tolist() == [(1 << 60) + 3, (1 << 60) + 2]
    assert hn.window_of(-10, 30, 90) == (-3, -9) and hn.window_of(7, 30, 90) == (3, 6)

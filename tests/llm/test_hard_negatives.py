"""Hard negatives against a comparison of every anchor with every row."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import hard_negatives as hn


def expected(rows, is_anchor, k=5, m=5, scale=256):
    """``rows`` are ``(id, vector, label)``; every number as it is, without bounds."""
    sound = [
        (i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, x, label in sound:
        if a is None or not is_anchor(a):
            continue
        others = [(-sum(p * q for p, q in zip(x, y)), math.inf if i is None else i, own == label) for i, y, own in sound if i is None or i != a]
        for minus, positive, _ in sorted(o for o in others if o[2])[:k]:
            fit = sorted(o for o in others if not o[2] and 80 * -minus <= 100 * -o[0] <= 100 * -minus)[:m]
            out += [(a, positive, rank, i, -minus, -s) for rank, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(math.inf if x is None else x for x in r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, row int, anchor int, positives string")


def mined(spark, rows, **options):
    return hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, **options)


@pytest.mark.parametrize(("slice_rows", "block"), [(8192, 8192), (40, 7)])
@pytest.mark.parametrize("width", [3, 20])
def test_equals_brute_force(spark, monkeypatch, slice_rows, block, width):
    monkeypatch.setattr(hn, "SLICE", slice_rows)
    monkeypatch.setattr(hn, "BLOCK", block)
    rng = np.random.default_rng(width)
    rows = [(i, v, i % 3) for i, v in enumerate(rng.normal(scale=0.2, size=(300, width)).astype(np.float32).tolist())]
    want = expected(rows, lambda i: i % 10 == 0)
    assert want
    assert got(mined(spark, rows)) == want


def test_ties_and_a_third_of_all_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(hn, "SLICE", 50)
    rng = np.random.default_rng(1)
    rows = [(i, [0.5, 0.5] if i % 3 == 0 else rng.integers(0, 3, 2).astype(float).tolist(), i % 2) for i in range(240)]
    assert got(mined(spark, rows)) == expected(rows, lambda i: i % 10 == 0)


def test_edge_cases(spark):
    rows = [
        (0, [1.0, 2.0], 1),
        (10, [1.0, 2.0, 0.0], 1),
        (10, [1.0, 2.0], 1),
        (1, [1.0, 1.9], 1),
        (2, [1.0, 1.9], 2),
        (3, [1.0, 1.8], 2),
        (4, [0.9, 1.8], 2),
        (5, [-1.0, -2.0], 2),
        (6, [], 2),
        (20, [-1.0, -1.0], 3),
        (7, [1.0, 1.0], 3),
        (None, [1.0, 1.9], 2),
        (None, [1.0, 1.9], 1),
        (30, [1.0, 2.0], None),
        (40, None, 1),
        (50, [None, 1.0], 1),
        (60, [float("nan"), 1.0], 1),
        (70, [float("-inf"), 1.0], 2),
    ]
    assert got(mined(spark, rows)) == expected(rows, lambda i: i % 10 == 0)
    assert mined(spark, []).count() == 0
    assert mined(spark, [(0, [], 1), (1, [], 2)]).count() == 0
    assert mined(spark, [(0, [1.0], 1)]).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [1e6 + i, -3e6 + 7 * i], i % 2) for i in range(40)]
    assert got(mined(spark, rows)) == expected([(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows], lambda i: i % 10 == 0)


def test_bounds_remove_rows_and_lose_none():
    rng = np.random.default_rng(2)
    columns = rng.integers(-64, 64, (32, 2000))
    anchor = rng.integers(-64, 64, 32)
    scores = anchor @ columns
    left, score = hn.scan(anchor, columns, columns.min(1), columns.max(1), np.arange(2000), 5, None)
    assert (scores[left] == score).all() and set(np.sort(score)[-5:]) == set(np.sort(scores)[-5:])
    assert len(left) < 100
    window = (int(np.quantile(scores, 0.9)), int(np.quantile(scores, 0.95)))
    left, score = hn.scan(anchor, columns, columns.min(1), columns.max(1), np.arange(2000), 5, [window])
    inside = np.sort(scores[(scores >= window[0]) & (scores <= window[1])])[-5:]
    assert set(inside) <= set(score) and len(left) < 400


def test_windows_are_exact_fractions():
    assert hn.window_of(7, Fraction(80, 100), Fraction(1)) == (6, 7)
    assert hn.window_of(-7, Fraction(80, 100), Fraction(1)) == (-5, -7)
    assert hn.window_of(10**18 + 1, Fraction(80, 100), Fraction(1)) == (8 * 10**17 + 1, 10**18 + 1)

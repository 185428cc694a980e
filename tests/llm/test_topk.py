import math
import random

import pytest
from pyspark.sql import functions as F

from stationflow.llm import topk


def brute(rows, k, every):
    sound = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in sound:
        if i is not None and i % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for j, v in sound if j is None or j != i]
            out[i] = [(-s, None if none else j) for s, none, j in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("pivots,block,part", [(8, 5, 40), (64, 2048, 16384), (1, 3, 7)])
@pytest.mark.parametrize("shape", ["clusters", "equal", "odd"])
def test_equals_brute_force(spark, shape, pivots, block, part):
    draw = random.Random(3)
    if shape == "equal":
        rows = [(i, [0.5, -0.25]) for i in range(60)]
    else:
        centres = [[draw.gauss(0, 3) for _ in range(6)] for _ in range(5)]
        rows = [(i, [float(c + draw.gauss(0, 0.2)) for c in draw.choice(centres)]) for i in range(150)]
    if shape == "odd":
        rows += [(None, [9.0] * 6), (200, None), (220, [float("nan")] * 6), (240, [None, 1.0]), (260, [float("inf")]), (280, [1.0, 2.0]), (300, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    got: dict = {}
    for r in topk.top_k(table, F.col("vec_id") % 20 == 0, k=7, pivots=pivots, block=block, slice_rows=part).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got == brute(rows, 7, 20)


def test_huge_components_stay_exact():
    import numpy as np

    big = np.array([[1 << 30, 3]], np.int64)
    assert topk.scores(big, big)[0, 0] == (1 << 60) + 9


def test_repeated_and_missing_ids_leave_the_bounds_in_place(spark, monkeypatch):
    """One id on many rows, and rows without id: same results as by brute force, and a finite bound for every cell."""
    draw = random.Random(11)
    centres = [[draw.gauss(0, 8) for _ in range(6)] for _ in range(12)]
    rows = [(i if i % 20 < 12 else 7 if i % 2 else None, [float(c + draw.gauss(0, 0.1)) for c in centres[i % 12]]) for i in range(720)]
    seen = []
    bounds = topk.needs

    def kept(close, far, between, k, slack):
        seen.append(bounds(close, far, between, k, slack))
        return seen[-1]

    monkeypatch.setattr(topk, "needs", kept)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got: dict = {}
    for r in topk.top_k(table, F.col("vec_id") % 20 == 0, k=7, pivots=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert got == brute(rows, 7, 20)
    assert seen and all(math.isfinite(n) for by_cell in seen[0].values() for n in by_cell)


def test_bounds_count_every_id_once():
    import numpy as np
    import pandas as pd

    close = pd.DataFrame({"cell": [0, 0, 1, 1], "vec_id": [1, 2, 1, 3], "away": [1.0, 2.0, 0.5, 4.0]})
    between = np.array([[0.0, 10.0], [10.0, 0.0]])
    # From cell 0: id 1 within 1 + 1, id 2 within 1 + 2, id 3 within 1 + 10 + 4.
    assert topk.needs(close, {0: 1.0}, between, 2, 0.0)[0].tolist() == [0 - 1 - 15, 10 - 1 - 15]
    assert topk.needs(close, {0: 1.0}, between, 3, 0.0)[0].tolist() == [-math.inf, -math.inf]

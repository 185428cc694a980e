"""Nearest neighbours against a comparison with every row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import ann, hnsw, queries


def every_50th():
    return F.col("vec_id") % 50 == 0


def expected(rows, is_query, k=5):
    """Best rows by cosine of ``(id, vector)`` pairs, ties to the smaller id."""
    sound = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in sound), default=0)
    x = np.array([[*v, *[0.0] * (width - len(v))] for _, v in sound])
    out = []
    for (i, _), q in zip(sound, x):
        if not is_query(i):
            continue
        score = x @ q / (np.sqrt((x * x).sum(1)) * np.sqrt(q @ q))
        others = [(-round(s, 12), math.inf if j is None else j) for (j, _), s in zip(sound, score) if j is None or j != i]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(others)[:k], 1)]
    return sorted(out)


def got(frame):
    return sorted((q, rank, math.inf if j is None else j, round(s, 12)) for q, rank, j, s in map(tuple, frame.collect()))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, node int, query int, score int")


def test_recall_on_the_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want = {(q, j) for q, _, j, _ in expected(rows, lambda i: i % 50 == 0)}
    have = queries.op11_hnsw_shards(spark, sf_dir)
    assert have.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    found = {(r["query_id"], r["vec_id"]) for r in have.collect()}
    assert len(found) == len(want)
    assert len(found & want) >= 0.9 * len(want)


@pytest.mark.parametrize("spread", ["even", "clusters"])
def test_recall_of_many_shards_and_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(ann, "ROOT", 10)
    monkeypatch.setattr(ann, "BLOCK", 20)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 32))
    if spread == "clusters":
        x = np.repeat(x[:30], 100, 0) + 0.1 * x
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    want = {(q, j) for q, _, j, _ in expected(rows, lambda i: i % 50 == 0)}
    found = {(q, j) for q, _, j, _ in got(ann.nearest(frame(spark, rows), every_50th()))}
    assert len(found & want) >= 0.95 * len(want)


def test_recall_of_one_large_graph():
    x = np.random.default_rng(3).normal(size=(6000, 48)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    layers = hnsw.build(x)
    assert [len(layer) for layer in layers] == sorted(len(layer) for layer in layers) and len(layers[-1]) == len(x)
    q = x[:300]
    best = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :6]
    found = hnsw.search(x, layers, q, 6)
    assert np.mean([len(set(a) & set(b)) for a, b in zip(found, best)]) >= 0.93 * 6


CASES = [
    (0, [1.0, 0.0, 0.0]),
    (50, [0.0, 2.0]),
    (50, [0.0, 2.0]),
    (7, [0.0, 4.0, 0.0]),
    (8, [3e38, 3e38, 0.0]),
    (9, [1e-30, 1e-30, 0.0]),
    (10, [0.0, 0.0, 0.0]),
    (11, []),
    (12, None),
    (100, [None, 1.0, 1.0]),
    (150, [float("nan"), 1.0, 1.0]),
    (200, [float("inf"), 1.0, 1.0]),
    (None, [0.0, 1.0, 0.0]),
    (None, [1.0, 0.0, 0.0]),
    (250, [-1.0, 0.0, 0.0]),
]


def test_edge_cases_equal_brute_force(spark):
    assert got(ann.nearest(frame(spark, CASES), every_50th())) == expected(CASES, lambda i: i is not None and i % 50 == 0)


def test_a_third_of_all_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROOT", 10)
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).astype(np.float32).tolist()) for i in range(1500)]
    want, have = expected(rows, lambda i: i % 50 == 0), got(ann.nearest(frame(spark, rows), every_50th()))
    assert len(have) == len(want)
    hot = [r for r in want if r[0] % 3 == 0]
    assert [r for r in have if r[0] % 3 == 0] == hot
    assert len(set(have) & set(want)) >= 0.95 * len(want)


def test_few_rows_and_none(spark):
    assert ann.nearest(frame(spark, []), every_50th()).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0])]), every_50th()).count() == 0
    assert ann.nearest(frame(spark, [(1, [1.0]), (2, [1.0])]), every_50th()).count() == 0
    assert got(ann.nearest(frame(spark, [(0, [1.0]), (2, [1.0])]), every_50th())) == [(0, 1, 2, 1.0)]


def test_queries_may_come_from_elsewhere(spark):
    index = ann.build_index(frame(spark, [(i, [1.0, float(i)]) for i in range(20)]), copies=4)
    asked = frame(spark, [(100, [1.0, 3.0, 5.0])])
    found = ann.search(index, asked, 3)
    assert [r["vec_id"] for r in found.orderBy("rank").collect()] == [3, 4, 5]

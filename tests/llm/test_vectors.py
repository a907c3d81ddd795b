"""Nearest neighbours against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from clicksieve.llm import vantage_points as vp
from clicksieve.llm.vantage_points import nearest


def rows_of(vectors):
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]


def distance(v, w):
    total = 0.0
    for a, b in zip(v, w):  # in order; sum() would compensate
        total += (a - b) * (a - b)
    return math.sqrt(total)


def brute(rows, asked, k):
    out = {}
    for i, v in rows:
        if i in asked:
            d = sorted((distance(v, w), j) for j, w in rows if j != i)
            out[i] = d[:k]
    return out


def test_exact(spark):
    rng = np.random.default_rng(2)
    data = np.vstack([rng.normal(size=(900, 8)), np.repeat(rng.normal(size=(1, 8)), 300, 0), rng.normal(size=(900, 8)) * 0.01 + 3])
    rows = rows_of(data)
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
    want = brute(rows, set(range(0, len(rows), 50)), 10)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    assert {q: [f[i] for i in range(1, 11)] for q, f in found.items()} == want


def test_smaller_factor_finds_most(spark):
    rng = np.random.default_rng(4)
    rows = rows_of(rng.normal(size=(4000, 16)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ask = F.col("vec_id") % 50 == 0
    exact, near = ({(r.query_id, r.vec_id) for r in nearest(df, ask, factor=f).collect()} for f in (1.0, 0.7))
    assert len(exact & near) >= 0.9 * len(exact)


def test_awkward(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]),
            (6, []), (7, [1.0, 1.0]), (7, [1.0, 2.0]), (None, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (100, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x")).withColumn("v", F.lit(1))
    got = nearest(df, F.col("vec_id") % 100 == 0).collect()
    by = {q: [(r.rank, r.vec_id, r.score) for r in got if r.query_id == q] for q in (0, 100)}
    assert by[0] == [(1, 8, 0.0), (2, 7, 1.0), (3, 100, 1.0)]
    assert [x[1] for x in by[100]] == [0, 8, 7]
    assert nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_few_exact_distances_where_nothing_is_left_out(monkeypatch):
    """Near random vectors of 64 dimensions: the tree opens every leaf, yet few pairs are measured in full."""
    rng = np.random.default_rng(6)
    data, ids, asked = rng.normal(size=(3000, 64)), np.arange(3000), np.arange(0, 3000, 20)
    measured = []
    count = lambda f, size: lambda a, b: measured.append(size(a, b)) or f(a, b)
    monkeypatch.setattr(vp, "distances", count(vp.distances, lambda a, b: len(a) * len(b)))
    monkeypatch.setattr(vp, "paired", count(getattr(vp, "paired", None), lambda a, b: len(a)), raising=False)
    tree = vp.build(data, ids)
    measured.clear()
    search = vp.Search(ids, data, asked, data[asked], 10, 1.0)
    search.walk(tree, np.arange(len(asked)))
    assert sum(measured) < 0.1 * len(asked) * len(data)
    for q, near in zip(asked, search.best_ids):
        assert near.tolist() == [j for _, j in sorted((distance(data[q], data[j]), j) for j in ids if j != q)[:10]]


def test_huge_tiny_and_equal_vectors():
    """Squares that overflow or underflow, and ties, are told by the exact distance."""
    data = np.vstack([np.full((700, 3), 1e155), np.full((5, 3), 1e-170) * np.arange(1, 6)[:, None], np.full((700, 3), 2.0)])
    data[3, 0] *= 1 + 1e-15
    ids = np.arange(len(data))[::-1].copy()
    search = vp.Search(ids, data, ids, data, 4, 1.0)
    with np.errstate(over="ignore"):
        search.walk(vp.build(data, np.arange(len(ids))), np.arange(len(ids)))
        for q in (0, 3, 699, 700, 704, 705, 1404):
            d = np.sqrt(((data - data[q]) ** 2).sum(1))
            assert search.best_ids[q].tolist() == [i for _, i in sorted(zip(d, ids)) if i != ids[q]][:4]

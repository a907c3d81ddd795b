"""Ranks, running values and clustering in small blocks, against plain versions."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicksieve.operators import cluster
from clicksieve.operators.ranks import number_rows, running
from test_units import greedy, kl


def test_places_and_running_values_of_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), rng.choice([None, *range(50)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i long").repartition(7)
    placed = number_rows(df, ["g"], ["v", "i"])
    got = running(placed, ["g"], "place", {"total": (F.sum, F.col("i")), "low": (F.min, F.col("v")), "x": (F.bit_xor, F.col("i"))}, block=16).collect()
    groups = defaultdict(list)
    for g, v, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        groups[g].append((v, i))
    want = {}
    for g, cells in groups.items():
        total = low = x = None
        for place, (v, i) in enumerate(cells):
            want[i] = (g, v, place, total, low, x)
            total, x = (total or 0) + i, (x or 0) ^ i
            low = v if low is None else low if v is None else min(low, v)
    assert {r.i: (r.g, r.v, r.place, r.total, r.low, r.x) for r in got} == want


def histograms(rng, groups, keys, used):
    """Groups around a few shapes, with many equal ones."""
    shapes = [{k: rng.randint(1, 60) for k in rng.sample(range(keys), used)} for _ in range(4)]
    out = {}
    for g in range(groups):
        shape = rng.choice(shapes)
        out[f"g{g:03}"] = {f"k{k}": max(0, n + rng.choice([0, 0, rng.randint(-8, 8)])) for k, n in shape.items()}
    return out


def long_rows(spark, hist):
    return spark.createDataFrame([(g, k, n) for g, h in hist.items() for k, n in h.items()], "g string, k string, n long")


def dense(hist):
    names = sorted({k for h in hist.values() for k in h})
    return {g: [h.get(k, 0) for k in names] for g, h in hist.items()}


@pytest.mark.parametrize("keys, used, block", [(12, 6, 8), (3000, 40, 1024)])
def test_divergences_of_long_histograms(spark, monkeypatch, keys, used, block):
    monkeypatch.setattr(cluster, "BLOCK", block)
    hist = histograms(random.Random(keys), 45, keys, used)
    vecs = dense(hist)
    want = {(a, b): kl(vecs[a], vecs[b]) for a in vecs for b in vecs if a != b}
    rows = long_rows(spark, hist)
    got = {(r.a, r.b): r.kl for r in cluster.pairwise_kl(rows, "g").collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    near = {(r.a, r.b) for r in cluster.near_pairs(rows, "g", 0.05).collect()}
    assert near == {p for p, d in want.items() if d < 0.05} and 0 < len(near) < len(want)


@pytest.mark.parametrize("seed, threshold, block", [(2, 0.3, 6), (3, 50.0, 4)])
def test_average_linkage_in_small_blocks(spark, monkeypatch, seed, threshold, block):
    """Clusters of more than half a block are cut, and their sums come from several cells."""
    monkeypatch.setattr(cluster, "BLOCK", block)
    rng = random.Random(seed)
    hist = histograms(rng, 20, 9, 5)
    for h in hist.values():  # no ties
        for k in h:
            h[k] += rng.random() / 10
    volumes = {g: rng.randint(1, 9) for g in hist}
    rows = spark.createDataFrame([(g, k, float(n)) for g, h in hist.items() for k, n in h.items()], "g string, k string, n double")
    sizes = spark.createDataFrame(list(volumes.items()), "g string, volume int")
    tags = defaultdict(set)
    for r in cluster.average_link_histograms(rows, sizes, "g", "volume", threshold).collect():
        tags[r.tag].add(r.g)
    vecs = {g: (v, volumes[g]) for g, v in dense(hist).items()}
    assert {frozenset(v) for v in tags.values()} == greedy(vecs, threshold)
    assert all(t == min(v) for t, v in tags.items())


def test_cluster_stats_from_sums(spark):
    rng = random.Random(9)
    hist = histograms(rng, 60, 15, 5)
    tags = {g: rng.choice(["x", "x", "x", "y", None]) for g in hist}
    tags["g000"] = "alone"
    members = spark.createDataFrame([(g, t, 10) for g, t in tags.items()], "g string, tag string, volume long")
    vecs = dense(hist)
    names = sorted({k for h in hist.values() for k in h})
    got = {(r.tag, r.k): r for r in cluster.cluster_stats(members, long_rows(spark, hist), "g", "tag", "volume", ["k0", "none"]).collect()}
    assert set(tags.values()) == {t for t, _ in got} and {(t, "none") for t in set(tags.values())} <= got.keys()
    for t in set(tags.values()):
        inside = sorted(g for g in tags if tags[g] == t)
        density = np.mean([kl(vecs[b], vecs[a]) for a, b in combinations(inside, 2)]) if len(inside) > 1 else 0.0
        for i, k in enumerate(names):
            column = [vecs[g][i] for g in inside]
            r = got.get((t, k))
            assert (r is None) == (not any(column) and k != "k0")
            if r:
                assert (r.nodes, r.volume) == (len(inside), 10 * len(inside)) and abs(r.density - density) < 1e-9
                assert abs(r["mean"] - np.mean(column)) < 1e-9 and abs(r["std"] - np.std(column)) < 1e-9


def test_keep_one_per_page_of_a_hot_site(spark):
    """100,000 distinct volumes on one site, whose runs hold thousands of channels."""
    rng = random.Random(4)
    volumes = rng.sample(range(1, 3_000_000), 100_000)
    rows = [("hot", f"c{i:06}", v) for i, v in enumerate(volumes)] + [("small", "a", 99), ("small", "b", 101), ("one", "z", 1)]
    want = {("small", "a"), ("small", "b"), ("one", "z")}
    anchor, last = 0, None
    for _, channel, v in sorted(rows[:100_000], key=lambda r: (-r[2], r[1])):
        if abs((v - anchor) / (v + anchor)) >= 0.01:
            want |= {("hot", last)} if last else set()
            anchor = v
        last = channel
    want.add(("hot", last))
    df = spark.createDataFrame(rows, "site string, srcg string, spv int")
    got = cluster.keep_one_per_page(df, "site", "srcg", "spv")
    assert {(r.site, r.srcg) for r in got.collect()} == want

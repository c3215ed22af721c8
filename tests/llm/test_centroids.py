"""op13: cover trees, dual-tree assignment and whole runs against plain loops."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import lloyd

SCHEMA = "vec_id long, embedding array<double>"


def clumped(rng, n, spread):
    return (rng.integers(-500, 500, (6, 64))[rng.integers(0, 6, n)] + rng.integers(-spread, spread + 1, (n, 64))).astype(np.int64)


@pytest.mark.parametrize("spread", [0, 2, 100, 2000])
def test_cover_tree(spread):
    """Radii cover, children of one node lie apart by over half of the level, every point is in one leaf."""
    points = np.unique(clumped(np.random.default_rng(spread), 300, spread), axis=0)
    tree, order = lloyd.cover_tree(points)
    assert (tree.points == points[order]).all() and sorted(order.tolist()) == list(range(len(points)))
    down, starts = tree.children()
    for n in range(len(tree.first)):
        away = np.sqrt(lloyd.squared(tree.points[tree.first[n] : tree.last[n]], tree.points[tree.center[n]]))
        assert tree.first[n] <= tree.center[n] < tree.last[n] and away.max() <= tree.radius[n]
        own = down[starts[n] : starts[n + 1]]
        if len(own):
            assert sum(tree.last[c] - tree.first[c] for c in own) == tree.last[n] - tree.first[n]
            centers = tree.points[tree.center[own]]
            apart = np.sqrt(lloyd.squared(centers[:, None], centers[None])) + np.eye(len(own)) * 1e9
            half = 2.0 ** (np.ceil(np.log2(away.max())) - 1)
            assert apart.min() > half and tree.radius[own].max() <= half * (1 + 1e-9)


@pytest.mark.parametrize("seed", range(12))
def test_assignment(seed):
    """The nearest centroid of every point, ties to the smaller number, and fewer exact distances than pairs where points are clumped."""
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 400)), int(rng.integers(1, 24))
    points = [clumped(rng, n, 20), rng.integers(-2, 3, (n, 64)) * (rng.random((1, 64)) < 0.05), rng.integers(-(1 << 27), 1 << 27, (n, 64))][seed % 3].astype(np.int64)
    centroids = points[rng.integers(0, n, k)]
    tree, _ = lloyd.cover_tree(np.unique(points, axis=0))
    found, taken = lloyd.assigned(tree, centroids)
    assert (found == lloyd.squared(tree.points[:, None], centroids[None]).argmin(1)).all()
    if seed % 3 == 0 and n > 50:
        assert taken < len(tree.points) * k


def plain(rows, k=8, rounds=10):
    ids, vs = [], []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) and abs(x) < 131_072 for x in e):
            ids.append(i)
            vs.append([int(np.floor(1024 * np.float64(x))) for x in e])
    if not vs:
        return []
    hashed = sorted((i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in zip(ids, vs))
    v, c = np.array(vs, np.int64), np.array([h[2] for h in hashed[:k]], np.int64)
    for _ in range(rounds):
        own = lloyd.squared(v[:, None], c[None]).argmin(1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = [int(s) // int((own == j).sum()) for s in v[own == j].sum(0)]
    d = lloyd.squared(v[:, None], c[None])
    own = d.argmin(1)
    d = d[np.arange(len(v)), own]
    return sorted(((i, int(j), int(x), int(d[own == j].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, x in zip(ids, own, d)), key=repr)


def found(spark, rows, **columns):
    told = lloyd.cluster(spark.createDataFrame(rows, SCHEMA).withColumns(columns))
    return sorted((tuple(r) for r in told.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_against_plain_loop(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), (v / 1000).tolist()) for k, v in enumerate(clumped(rng, 500, 120))]
    rows += [(1000 + k, rows[0][1]) for k in range(250)]  # a third of all are one vector
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(k, rng.normal(size=64).tolist()) for k in range(30)]
    odd = [(50, None), (51, []), (52, [0.5] * 63), (53, [0.5] * 65), (54, [float("nan")] + [0.0] * 63), (55, [float("inf")] + [0.0] * 63), (56, [None] + [0.0] * 63), (57, [1e300] + [0.0] * 63), (None, good[0][1]), (3, good[1][1]), (3, good[3][1]), (58, [-131_071.5] + [131_071.5] * 63), (59, [-1e-9] * 64)]
    assert found(spark, good + odd) == plain(good + odd)
    assert found(spark, good + odd, cluster=F.lit("x"), v=F.lit(0), ids=F.lit(1), distance=F.lit(None)) == plain(good + odd)


def test_few_and_none(spark):
    few = [(k, [float(k)] * 64) for k in range(3)]
    assert found(spark, few) == plain(few)
    same = [(k, [1.0] * 64) for k in range(20)] + [(None, [2.0] * 64)]
    assert found(spark, same) == plain(same)
    assert found(spark, []) == [] and found(spark, [(1, [1.0])]) == []

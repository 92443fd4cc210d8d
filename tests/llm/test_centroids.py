"""Centroid clusters against plain loops over Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from hintforge.llm import centroid_clusters
from hintforge.llm.centroid_clusters import cluster_vectors, nearest

rng = random.Random(13)


def brute(rows, clusters, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "z"
    centroids = [list(v) for _, v in sorted(kept, key=lambda r: (name(r), np.array(r[1], "<i4").tobytes()))[:clusters]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda v: min((distance(v, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        went = [place(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            if mine := [v for (_, v), w in zip(kept, went) if w == k]:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [place(v) for _, v in kept]
    inertia = {k: sum(d for d, w in last if w == k) for _, k in last}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for (i, _), (d, k) in zip(kept, last)), key=repr)


def run(spark, rows, **params):
    table = spark.createDataFrame([(i, v, 1, b"x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, code binary")
    return sorted(map(tuple, cluster_vectors(table, **params).collect()), key=repr)


def vector(dims, spread=1.0):
    return [float(np.float32(rng.gauss(0, spread / (1 + d % 7)))) for d in range(dims)]


def test_clusters(spark):
    rows = [(i, vector(64)) for i in range(300)] + [(1000 + i, [0.25] * 64) for i in range(30)]
    rows += [(None, vector(64)), (None, None), (7, None), (8, []), (9, vector(63)), (10, vector(65)), (11, [None, *vector(63)]), (12, [float("nan"), *vector(63)]), (13, [float("-inf"), *vector(63)]), (5, vector(64)), (5, vector(64))]
    assert run(spark, rows) == brute(rows, 40, 5, 64)


def test_ties_copies_and_few_vectors(spark):
    few = [(i, [float(i % 3), 0.0, -1.0] * 5) for i in range(9)]
    assert run(spark, few, clusters=4, rounds=3, dims=15) == brute(few, 4, 3, 15)
    assert run(spark, few[:2], clusters=5, rounds=2, dims=15) == brute(few[:2], 5, 2, 15)
    grid = [(i, [float(rng.randint(-2, 2)) for _ in range(20)]) for i in range(200)]
    assert run(spark, grid, clusters=12, rounds=4, dims=20) == brute(grid, 12, 4, 20)
    assert run(spark, [(1, None)], clusters=4, rounds=2, dims=15) == [] and run(spark, [], clusters=4, rounds=2, dims=15) == []


def test_nearest_is_exact_whatever_the_order():
    for spread in (1, 40, 3000):
        x, c = (np.array([[int(rng.gauss(0, spread)) for _ in range(24)] for _ in range(n)]) for n in (500, 17))
        c[5], c[9] = c[3], c[3]
        full = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        for order in (np.arange(24), np.arange(24)[::-1]):
            number, distance = nearest(x, c, order)
            assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_centroids_are_abandoned_early(monkeypatch):
    seen = []
    whole = np.einsum
    monkeypatch.setattr(centroid_clusters.np, "einsum", lambda s, a, b: seen.append(a.size) or whole(s, a, b))
    c = np.array([[1000 * k] * 64 for k in range(40)])
    nearest(np.repeat(c, 10, axis=0) + 3, c, np.arange(64))
    assert sum(seen) < 0.35 * 400 * 40 * 64


def test_components_beyond_the_range_are_an_error(spark):
    with pytest.raises(Exception, match="beyond 65536"):
        run(spark, [(1, [1e6] * 4)], clusters=1, rounds=1, dims=4)

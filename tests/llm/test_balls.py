"""Operator 11 against plain k-means in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from lexstrata.llm import balls


def plain(rows, k=8, rounds=10, dims=64, seed=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(1024 * x) for x in v]
            if max(map(abs, x)) <= balls.widest(dims):
                kept.append((i, x))
    hashed = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    cs = [x for _, x in hashed[:k]]
    d2 = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    assign = lambda: [min(range(len(cs)), key=lambda c: (d2(x, cs[c]), c)) for _, x in kept] if cs else []
    for _ in range(rounds):
        at = assign()
        for c in range(len(cs)):
            mine = [x for (_, x), a in zip(kept, at, strict=True) if a == c]
            if mine:
                cs[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    at = assign()
    far = [d2(x, cs[a]) for (_, x), a in zip(kept, at, strict=True)]
    sums = [sum(d for d, a in zip(far, at, strict=True) if a == c) for c in range(len(cs))]
    name = lambda c: hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest()
    return sorted(((i, a, d, sums[a], sum(far), name(a)) for (i, _), a, d in zip(kept, at, far, strict=True)), key=repr)


def got(spark, rows, kind="float", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "'x' AS cluster", "1 AS x", "2 AS ids").repartition(3)
    out = balls.ball_kmeans(df, **options).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def vectors(n, spread, seed=1):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [float(np.float32(c + rng.gauss(0, spread))) for c in middle[rng.randrange(5)]]) for i in range(n)]


@pytest.mark.parametrize("spread", [0.1, 1.5])
def test_equals_plain_kmeans(spark, spread):
    rows = vectors(300, spread)
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(5, rows[7][1]), (None, rows[9][1]), (None, rows[9][1])]  # copies, a repeated id, null ids
    assert got(spark, rows) == plain(rows)


def test_vectors_that_are_left_out(spark):
    rows = vectors(20, 0.5)
    bad = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63), (105, [float("nan")] + [1.0] * 63), (106, [float("inf")] + [1.0] * 63), (107, [1e30] + [1.0] * 63)]
    assert got(spark, rows + bad) == plain(rows)
    assert got(spark, [(1, None)]) == [] and got(spark, []) == []


def test_ties_few_vectors_and_wide_components(spark):
    assert got(spark, [(1, [1.0] * 64), (2, [1.0] * 64), (3, [2.0] * 64)]) == plain([(1, [1.0] * 64), (2, [1.0] * 64), (3, [2.0] * 64)])
    rng = random.Random(4)
    wide = [(i, [rng.choice((-90000.25, 90000.5, 0.0001)) for _ in range(64)]) for i in range(20)]
    assert got(spark, wide, "double") == plain(wide)


def test_only_neighbours_are_compared(monkeypatch):
    """Well parted clusters: with the right guess, each row meets its own centroid alone."""
    x = np.repeat(np.arange(8)[:, None] * 10_000, 64, axis=1).astype(np.int64)
    members = np.repeat(x, 50, axis=0) + np.random.default_rng(1).integers(-9, 9, (400, 64))
    met = []
    monkeypatch.setattr(balls, "squared", lambda a, c, f=balls.squared: met.append(len(a)) or f(a, c))
    cluster, distance = balls.assigned(members, np.repeat(np.arange(8), 50), x)
    assert (cluster == np.repeat(np.arange(8), 50)).all() and (distance == ((members - x[cluster]) ** 2).sum(axis=1)).all()
    assert sum(met) == 400 + 8 * 8  # the members, and the centroids among themselves

import hashlib
import math

import numpy as np
import pytest

from chronofold.llm import centroids

RNG = np.random.default_rng(29)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, v int")


def brute(rows, clusters=16, rounds=3, dimensions=64):
    """In Python's whole numbers."""
    most = centroids.LARGEST
    kept = [
        (i, [math.floor(min(max(64 * x, -most), most)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}") if r[0] is not None else "", r[1]))][:clusters]
    for turn in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres)) for _, v in kept]
        if turn < rounds:
            for k in range(len(centres)):
                mine = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == k]
                if mine:
                    centres[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    total = sum(d for d, _ in found) if kept else 0
    inertia = {k: sum(d for d, c in found if c == k) for k in range(len(centres))}
    return [(i, k, d, inertia[k], total, sha(",".join(map(str, centres[k])))) for (i, _), (d, k) in zip(kept, found, strict=True)] if kept else []


def check(spark, rows, **options):
    found = centroids.cluster_vectors(table(spark, rows).repartition(3), **options).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute(rows, **options), key=str)


@pytest.mark.parametrize("n", [0, 1, 10, 300])
def test_against_brute_force(spark, n):
    vectors = RNG.normal(size=(n, 64)) + RNG.integers(0, 4, (n, 1)) * 3 - 5
    check(spark, [(3 * i, v.tolist()) for i, v in enumerate(vectors)])


def test_awkward_rows(spark):
    grid = [(i, [float(i % 3), *[0.0] * 63]) for i in range(40)]  # ties and repeated vectors
    odd = [(100, None), (101, [1.0] * 63), (102, [1.0] * 65), (103, [None, *[1.0] * 63]), (104, [float("nan"), *[1.0] * 63]),
           (105, [float("-inf"), *[1.0] * 63]), (None, [0.5] * 64), (7, [9.0] * 64), (7, [9.0] * 64), (106, [-1e-9] * 64), (107, [1e300] * 64)]
    check(spark, grid + odd)
    check(spark, odd)
    check(spark, [(None, [0.5] * 64), (None, [0.25] * 64)])
    check(spark, grid, clusters=3, rounds=1)


def test_other_lengths(spark):
    check(spark, [(i, v.tolist()) for i, v in enumerate(RNG.normal(size=(50, 5)))], dimensions=5, clusters=4)


def test_pivots_spare_exact_distances():
    centres = RNG.integers(-2000, 2000, (16, 64))
    vectors = centres[RNG.integers(0, 16, 3000)] + RNG.integers(-20, 20, (3000, 64))
    fixed = centroids.choose_pivots(vectors[:256], 8)
    assert len(np.unique(fixed, axis=0)) == 8
    far, centre_far = centroids.pivot_distances(vectors, fixed), centroids.pivot_distances(centres, fixed)
    cluster, best, exact = centroids.assign(vectors, far, centres, centre_far)
    every = ((vectors[:, None] - centres[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (best == every.min(1)).all()
    assert exact < 0.2 * every.size

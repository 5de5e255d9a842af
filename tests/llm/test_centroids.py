"""Orchard's search and the clustering against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest

from sieveline.llm import centroids as C

WIDTH = 6


def vectors(spark, rows):
    made = spark.createDataFrame(list(rows), "vec_id long, embedding array<float>")
    return made.selectExpr("*", *[f"'x' AS {n}" for n in ("v", "cluster", "distance", "n", "sums", "hash", "inertia", "centroid")])


def plain(rows, k, rounds, width=WIDTH):
    kept = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) and abs(x) <= 65536 for x in v)]
    hashed = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in hashed[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            centres[j] = tuple(sum(col) // len(g) for col in zip(*g))
    out = [(i, *nearest(v)) for i, v in kept]
    spread = {}
    for _, d, j in out:
        spread[j] = spread.get(j, 0) + d
    return sorted((str(i), j, d, spread[j], sum(spread.values()), list(centres[j])) for i, d, j in out)


def cases():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(WIDTH)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * WIDTH) for i in range(300)]  # a hot group of equal vectors
    rows += [(7, rows[7][1]), (7, rows[7][1]), (9, [1.0] * WIDTH), (-4, rows[1][1]), (None, [0.25] * WIDTH), (None, None)]
    rows += [(2000, None), (2001, []), (2002, [1.0]), (2003, [1.0] * (WIDTH + 1)), (2004, [0.0] * WIDTH)]
    rows += [(2005, [float("nan")] * WIDTH), (2006, [None] + [1.0] * (WIDTH - 1)), (2007, [float("inf")] * WIDTH)]
    rows += [(2008, [1e30] * WIDTH), (2009, [65536.0] * WIDTH), (2010, [-65536.0] * WIDTH), (2011, [-0.001] * WIDTH)]
    return rows


@pytest.mark.parametrize("k, rounds", [(1, 2), (7, 5), (40, 5), (900, 1)])
def test_against_plain(spark, k, rounds):
    rows = cases()
    made = C.cluster(vectors(spark, rows), k, rounds, WIDTH).collect()
    assert sorted((str(r[0]), *r[1:]) for r in made) == plain(rows, k, rounds)


def test_empty(spark):
    assert C.cluster(vectors(spark, []), width=WIDTH).count() == 0
    assert C.cluster(vectors(spark, [(1, None), (2, [])]), width=WIDTH).count() == 0


def test_search_is_exact_and_skips():
    """Ties go to the smaller number, and on grouped data most centroids are never measured."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-3, 4, (40, 3)) * 1000
    index = C.Orchard(centres)
    x = centres[rng.integers(0, 40, 5000)] + rng.integers(-50, 51, (5000, 3)) * 10
    x[:500] = (centres[rng.integers(0, 40, 500)] + centres[rng.integers(0, 40, 500)]) // 2  # many ties
    at, best = index.nearest(x)
    gaps = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (best == gaps.min(axis=1)).all() and (at == gaps.argmin(axis=1)).all()
    assert index.measured < 0.7 * gaps.size

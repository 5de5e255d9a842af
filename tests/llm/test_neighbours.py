"""Neighbours found by the tree against all distances."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import neighbours as A


def vectors(spark, rows):
    made = spark.createDataFrame(list(rows), "vec_id long, embedding array<float>")
    names = ("v", "leaf", "part", "turn", "kind", "query_id", "score", "rank", "parts", "turns", "kept")
    return made.selectExpr("*", *[f"'x' AS {n}" for n in names])


def plain(rows, k=10):
    kept = {}
    for i, v in rows:
        if i is None or not v or not all(x is not None and math.isfinite(x) for x in v):
            continue
        v = tuple(float(np.float32(x)) for x in v)
        if any(v):
            kept[i] = min(kept.get(i, v), v)
    return {
        i: sorted((math.dist(v, w), j) for j, w in kept.items() if j != i and len(w) == len(v))[:k]
        for i, v in kept.items() if i % 100 == 0
    }


def cases():
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(1500)]
    rows += [(5000 + i, rows[100][1]) for i in range(700)]  # copies: ties and a leaf that cannot be split
    rows += [(200, rows[5][1]), (200, rows[200][1]), (-100, rows[7][1])]
    rows += [(6000, [1.0, 2.0]), (6001, [1.0, 2.5]), (6002, [1.0, 2.5]), (6100, [3.0]), (None, [1.0] * 8)]
    rows += [(6200, [0.0] * 8), (6300, None), (6400, []), (6500, [None] * 8), (6600, [float("nan")] * 8), (6700, [float("inf")] * 8)]
    return rows


def found(made):
    out = {}
    for r in sorted(made.collect(), key=lambda r: r.rank):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def close(a, b):
    return [i for _, i in a] == [i for _, i in b] and np.allclose([s for s, _ in a], [s for s, _ in b], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("sizes", [{}, {"PART_ROWS": 40, "PART_VISITS": 3, "LEAF_ROWS": 20, "FIT_ROWS": 100, "BRANCHES": 4}])
def test_full_visits_are_exact(spark, monkeypatch, sizes):
    """A target of everything makes the search exact: ties, copies, widths and unusable rows."""
    for name, value in sizes.items():
        monkeypatch.setattr(A, name, value)
    monkeypatch.setattr(A, "CALIBRATION", 1000)
    rows = cases()
    got, expected = found(A.search(vectors(spark, rows), F.col("vec_id") % 100 == 0, target=1.0)), plain(rows)
    assert set(got) == {i for i, near in expected.items() if near}
    assert all(close(got[i], expected[i]) for i in got)


def test_recall_with_few_visits(spark):
    """On grouped vectors the promised recall is reached, in a small part of the leaves."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    x = centres[rng.integers(0, 60, 6000)] + 0.15 * rng.normal(size=(6000, 16))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    made = A.search(vectors(spark, rows), F.col("vec_id") % 100 == 0)
    got, expected = found(made), plain(rows)
    hits = sum(len({j for _, j in got[i]} & {j for _, j in near}) for i, near in expected.items())
    assert hits >= 0.9 * 10 * len(expected) and all(len(near) == 10 for near in got.values())
    leaves = made.select("leaves").first()[0]
    assert leaves <= 8


def test_small_and_empty(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [2.0]), (2, [2.0])], [(0, [0.0]), (100, None)]):
        got = found(A.search(vectors(spark, rows), F.col("vec_id") % 100 == 0))
        assert got == {i: near for i, near in plain(rows).items() if near}

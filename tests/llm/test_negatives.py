"""Hard negatives against scores of every anchor and row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import negatives as N


def vectors(spark, rows):
    made = spark.createDataFrame(list(rows), "vec_id long, embedding array<float>, label int")
    names = ("v", "shard", "part", "kind", "own", "anchor_id", "positive_score", "rank", "place", "kept")
    return made.selectExpr("*", *[f"'x' AS {n}" for n in names])


def plain(rows, n_positives=5, n_negatives=10):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or not v or not all(x is not None and math.isfinite(x) and abs(x) <= 65536 for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        kept[i] = min(kept.get(i, (whole, label)), (whole, label))
    out = []
    for i, (v, label) in kept.items():
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, (w, other) in kept.items() if j != i and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:n_positives]:
            inside = [(s, j) for s, j, other in scored if other != label and 30 * -ps <= 100 * -s <= 90 * -ps]
            out += [(i, p, rank + 1, j, -ps, -s) for rank, (s, j) in enumerate(inside[:n_negatives])]
    return sorted(out)


def cases():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(40)], rng.choice([0, 1, 1, 2, 9])) for i in range(900)]
    rows += [(2000 + i, rows[100][1], 1) for i in range(200)]  # copies: ties
    rows += [(3000 + i, rows[300][1], 0) for i in range(60)]
    rows += [(200, rows[5][1], 2), (200, rows[200][1], rows[200][2]), (-100, rows[7][1], 3)]
    rows += [(4000, [0.5, 0.5], 1), (4001, [0.5, 0.25], 1), (4002, [0.25, 0.25], 2), (4003, [0.5], 2), (4100, [0.0] * 40, 1)]
    rows += [(4200, None, 1), (4300, [], 1), (4400, [float("nan")] * 40, 1), (4500, [None] * 40, 1), (4600, [1e20] * 40, 1)]
    rows += [(None, [0.1] * 40, 1), (4700, [0.1] * 40, None), (4800, [-65536.0] * 40, 1), (4900, [65536.0] * 40, 1), (4901, [40000.5] * 40, 2)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"SHARD_BYTES": 4000, "PART_ANCHORS": 3, "LEAST_SHARDS": 1}, {"STEP": 3, "LEAST_SHARDS": 2}])
def test_against_plain(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(N, name, value)
    rows = cases()
    made = N.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in made.collect()) == plain(rows)


def test_few_and_none(spark):
    few = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (100, [0.0, 1.0], 5)]
    for rows in (few, [], few[:1]):
        made = N.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0)
        assert sorted(tuple(r) for r in made.collect()) == plain(rows)


def test_bounds_save_reading():
    """Vectors with few large components: most columns of most candidates stay unread."""
    rng = np.random.default_rng(2)
    x = np.zeros((4000, 64), dtype=np.int64)
    groups = rng.integers(0, 16, 4000)
    x[np.arange(4000)[:, None], groups[:, None] * 4 + np.arange(4)] = rng.integers(60, 130, (4000, 4))
    columns = N.Columns(np.arange(4000), np.zeros(4000, dtype=np.int64), x)
    best = columns.positives(x[0], 0, 0, 5)
    scores = x @ x[0]
    assert best == [(int(i), int(scores[i])) for i in np.lexsort((np.arange(4000), -scores)) if i][:5]
    assert columns.read < 0.4 * x.size

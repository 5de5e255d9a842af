"""The classifier's parts, what it learns from, and how well it does on held-out rows."""

import random
import zlib

import numpy as np
import pytest

from corpus_rows import rows_of  # noqa: F401
from sieveline.llm import quality as Q
from sieveline.sources.tables import load

MEDIUM = "/root/testdata/sf0.01"


def test_isotonic_is_the_best_rising_fit():
    rng = random.Random(0)
    for _ in range(50):
        n = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 9))]
        y = [rng.randrange(k + 1) for k in n]
        x, values = Q.isotonic(range(len(n)), n, y)
        assert list(values) == sorted(values) and len(set(values)) == len(values)
        # minimum over ends of maximum over starts of the block means
        best = [min(max(sum(y[a:b + 1]) / sum(n[a:b + 1]) for a in range(i + 1)) for b in range(i, len(n))) for i in range(len(n))]
        assert sorted(set(np.round(best, 12))) == pytest.approx(list(np.round(values, 12)))


def test_cosines_approximate_the_kernel():
    rng = np.random.RandomState(1)
    stats = rng.standard_normal((40, Q.N_STATISTICS))
    x = Q._cosines(stats, np.zeros(Q.N_STATISTICS), np.ones(Q.N_STATISTICS))[:, :-1]
    gaps = ((stats[:, None] - stats[None]) ** 2).sum(axis=2)
    assert np.abs(x @ x.T - np.exp(-gaps / (2 * Q.WIDTH**2))).max() < 0.35


def test_normal_equations_are_the_plain_sums(spark):
    rng = np.random.RandomState(2)
    stats, y = rng.standard_normal((70, Q.N_STATISTICS)), rng.randint(0, 2, 70).astype(float)
    rows = spark.createDataFrame([(i, s.tolist(), float(t)) for i, (s, t) in enumerate(zip(stats, y))], "doc_id long, stats array<double>, y double")
    mean, scale = np.zeros(Q.N_STATISTICS), np.ones(Q.N_STATISTICS)
    gram, target = Q._normal_equations(rows, mean, scale)
    x = Q._cosines(stats, mean, scale)
    assert np.allclose(gram, x.T @ x) and np.allclose(target, x.T @ y)


def test_held_out_accuracy_and_labels_used(spark):
    docs, labels = load(spark, MEDIUM, "documents"), load(spark, MEDIUM, "labels")
    made = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(made) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [d for d in known if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, r in made.items() if r.held_out} >= set(held)
    assert all(made[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d in made)
    assert sum(made[d].predicted == known[d] for d in held) / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in made.values())
    # labels of held-out rows, ids, languages and sources change nothing
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "'x' AS stats")
    changed = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'q' AS source")
    again = {r.doc_id: r.score for r in Q.classify(changed, other).collect()}
    assert again == {d: r.score for d, r in made.items()}


def test_keep_good_agrees_with_scores(spark):
    docs, labels = load(spark, MEDIUM, "documents"), load(spark, MEDIUM, "labels")
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in Q.classify(docs, labels).filter("predicted = 1").collect()}


def test_odd_rows_and_no_labels(spark, rows_of):
    rows = rows_of([(1, None), (1, ""), (None, "word " * 300_000), (2, "||| ###"), (2, "||| ###")])
    none = spark.createDataFrame([(1, None), (77, 1)], "doc_id long, quality int")
    assert [(r.score, r.predicted) for r in Q.classify(rows, none).collect()] == [(0.5, 1)] * 5
    few = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in Q.classify(rows, few).collect())
    assert Q.classify(rows_of([]), few).count() == 0 and Q.keep_good(rows_of([]), few).count() == 0

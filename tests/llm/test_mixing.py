"""Targets, rates and copies against plain sums and bisection."""

import math
import random
import re

import pytest

from sieveline.llm import mixing as M


def plain_targets(sizes, budget=1.5):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = budget * sum(sizes.values())
    full = set()
    while True:
        open_ = [s for s in names if s not in full]
        share = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else weight[s] * share for s in names}
        full |= over


def plain_rates(sizes, target):
    """Rates of one source's documents, by bisection on the multiplier."""
    words = [s for s in sizes if s]
    mean = sum(sizes) / len(sizes)
    low, high = -200.0, 200.0 * mean
    for _ in range(300):
        middle = (low + high) / 2
        taken = sum(s * min(2.0, math.exp(min(50, middle * s / mean))) for s in words)
        low, high = (middle, high) if taken < target else (low, middle)
    return {s: min(2.0, math.exp(min(50, low * s / mean))) for s in words}


def cases():
    rng = random.Random(4)
    docs = []
    for i in range(400):
        source = None if i % 23 == 0 else "hot" if i % 3 == 0 else f"src{i % 11}"
        docs.append((i, " ".join(["w"] * int(rng.expovariate(1 / 60) + 1)), source))
    docs += [(900, None, "src1"), (901, "", "src1"), (902, "  \t", "empty"), (None, "a b c", "src2"), (5, docs[5][1], docs[5][2])]
    docs += [(1000 + i, "same text here", "copies") for i in range(50)]
    return docs


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "'x' AS size", "'y' AS target", "1 AS src", "2 AS n", "3 AS copies")


def test_targets_rates_and_copies(table):
    docs = cases()
    made = M.mix(table(docs)).collect()
    assert len(made) == len(docs)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = {}
    for _, text, source in docs:
        by.setdefault(source, []).append(size(text))
    targets = plain_targets({s: sum(v) for s, v in by.items()})
    for r in made:
        assert r.source_size == sum(by[r.source]) and r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
    for source, sizes in by.items():
        own = [r for r in made if r.source == source]
        if 0 < targets[source] < 2 * sum(sizes) * (1 - 1e-9):
            expected = plain_rates(sizes, targets[source])
            for r in own:
                assert r.rate == pytest.approx(expected.get(r.size, 1.0), rel=1e-4, abs=1e-6)
        taken = sum(r.taken for r in own)
        assert abs(taken - targets[source]) <= max(sizes)
        if len(sizes) > 20:
            assert taken == pytest.approx(targets[source], rel=0.05, abs=3)
    again = M.mix(table(list(reversed(docs)))).collect()
    assert sorted(map(str, made)) == sorted(map(str, again))


def test_saturated_and_single_sources(table):
    docs = [(1, "a b c d", "x"), (2, "a", "y"), (3, "a b", "z")]
    made = {r.doc_id: r for r in M.mix(table(docs)).collect()}
    assert {r.source: r.target for r in made.values()} == pytest.approx(plain_targets({"x": 4, "y": 1, "z": 2}))
    assert sum(r.target for r in made.values()) == pytest.approx(10.5)


def test_repeat_gives_copies_with_all_columns(table):
    docs = cases()
    rows = table(docs)
    copies = {}
    for r in M.mix(rows).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    got = {}
    repeated = M.repeat(rows)
    assert repeated.columns == rows.columns
    for r in repeated.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: c for d, c in copies.items() if c}


def test_large_cells_are_ranked_in_parts(table, monkeypatch):
    docs = [(i, "a b c", "s") for i in range(200)] + [(300 + i, "a b", "t") for i in range(200)] + [(900, "a b c d", "u")]
    whole = {r.source: 0 for r in M.mix(table(docs)).collect()}
    monkeypatch.setattr(M, "RANKED", 16)
    for r in M.mix(table(docs)).collect():
        whole[r.source] += r.taken
        target = {"s": 0, "t": 0, "u": 0} | {r.source: r.target}
    targets = plain_targets({"s": 600, "t": 400, "u": 4})
    assert all(abs(whole[s] - targets[s]) <= 4 for s in whole) and target


def test_empty_table(table):
    assert M.mix(table([])).count() == 0 and M.repeat(table([])).count() == 0

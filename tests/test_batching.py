import random

import pytest
from pyspark.sql import functions as F

from sieveline.operators import batching
from sieveline.operators.batching import (
    assign_batches, batch_table, number_rows, number_rows_by_range, prefix_sum, replay_epochs, replay_files,
)


def table(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)


def batches(df):
    sizes = {r.batch_no: r.n for r in df.groupBy("batch_no").agg(F.count("*").alias("n")).collect()}
    return [sizes[b] for b in sorted(sizes)]


@pytest.mark.parametrize("n, size, expected", [
    (12, 4, [4, 4, 4]), (13, 4, [4, 4, 4]), (14, 4, [4, 4, 4]), (15, 4, [4, 4, 4, 3]),
    (2, 4, []), (3, 4, [3]), (5, 1, [1] * 5), (399, 100, [100, 100, 100, 99]), (87, 100, []),
])
def test_tail_rule(spark, n, size, expected):
    made = batch_table(table(spark, range(n)), "k", size, keep_tail=False)
    whole = batch_table(table(spark, range(n)), "k", size)
    assert batches(whole) == [size] * (n // size) + [n % size] * (n % size > 0)
    assert batches(made) == expected
    # The rule as a loop over start positions.
    starts = range(0, n - size + 2, size)
    assert [len(range(n)[s:s + size]) for s in starts if s < n] == expected


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        assign_batches(number_rows(table(spark, range(3)), "k"), 0)


def test_order_and_positions(spark):
    keys = random.Random(1).sample(range(10**6), 500)
    rows = batch_table(table(spark, keys), "k", 50).collect()
    by_key = sorted(rows, key=lambda r: r.k)
    assert [r.row_no for r in by_key] == list(range(500))
    assert [(r.batch_no, r.row_in_batch) for r in by_key] == [(i // 50 + 1, i % 50) for i in range(500)]


def test_empty_table(spark):
    assert batch_table(table(spark, []).limit(0), "k", 4).collect() == []


@pytest.mark.parametrize("keys", [
    list(range(-300, 300)),
    [i * 10**15 for i in range(-200, 200)],               # sparse: too wide for buckets
    list(range(500)) + [2**62],                           # nearly all rows in one key range
    [-(2**63), 2**63 - 1, 0, 5],
])
def test_numbering_ways_agree(spark, keys):
    df = table(spark, keys)
    first = {r.k: (r.row_no, r.n_rows) for r in number_rows(df, "k").collect()}
    second = {r.k: (r.row_no, r.n_rows) for r in number_rows_by_range(df, ["k"]).collect()}
    assert first == second == {k: (i, len(keys)) for i, k in enumerate(sorted(keys))}


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(batching, "BUCKET_WIDTH", 7)
    keys = list(range(0, 400, 3))
    made = {r.k: r.row_no for r in number_rows(table(spark, keys), "k").collect()}
    assert made == {k: i for i, k in enumerate(keys)}


def files(spark):
    """A third of all rows in one file, one file too short for a batch."""
    sizes = {0: 9, 1: 40, 2: 2, 3: 11}
    rows = [(f, f * 1000 + i) for f, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "f int, k long").repartition(4), sizes


def test_files_follow_one_another(spark):
    df, sizes = files(spark)
    rows = replay_files(df, "f", "k", 5).collect()
    per_file = {}
    for r in rows:
        per_file.setdefault(r.f, set()).add(r.batch_no)
    # 9 = 5 + 4, 40 = 8 x 5, 2 is dropped, 11 = 5 + 5 + 1 dropped.
    assert {f: sorted(b) for f, b in per_file.items()} == {0: [1, 2], 1: list(range(3, 11)), 3: [11, 12]}
    assert len(rows) == 9 + 40 + 10
    for r in rows:
        assert r.row_in_batch == (r.k % 1000) % 5


def test_numbering_within_files_by_range(spark):
    df, sizes = files(spark)
    rows = number_rows_by_range(df, ["k"], within="f").collect()
    assert len(rows) == sum(sizes.values())
    assert all(r.row_no == r.k % 1000 and r.n_rows == sizes[r.f] for r in rows)


def test_epochs(spark):
    rows = replay_epochs(batch_table(table(spark, range(10)), "k", 4, keep_tail=False), 4, 3)
    assert batches(rows) == [4] * 6
    firsts = {r.batch_no: r.k for r in rows.filter("row_in_batch = 0").collect()}
    assert firsts == {1: 0, 2: 4, 3: 0, 4: 4, 5: 0, 6: 4}
    with pytest.raises(ValueError):
        replay_epochs(table(spark, range(10)), 4, 0)


@pytest.mark.parametrize("block", [3, 10, 1000])
def test_prefix_sum_in_blocks(spark, block):
    rng = random.Random(2)
    rows = [(k, i, float(rng.randint(0, 9))) for k in "ab" for i in range(1, 41) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    made = {(r.k, r.i): r.s for r in prefix_sum(df, "i", {"v": "s"}, keys=["k"], block=block).collect()}
    assert made == {(k, i): sum(v for a, j, v in rows if a == k and j <= i) for k, i, _ in rows}
    plain = {(r.k, r.i): r.s for r in prefix_sum(df, "i", {"v": "s"}, keys=["k"], span=41).collect()}
    assert plain == made

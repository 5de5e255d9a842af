import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.functions.hashing import N_BUCKETS
from sieveline.operators import curves as C
from sieveline.operators import kmeans, sharded
from sieveline.operators.metrics import classification_metrics, confusion_matrix, dual_polarity, confusion_counts, error_rate, invert_predictions
from sieveline.operators.models import (
    CLUSTERING, HIDDEN_UNITS, LOGISTIC, MLP, NAIVE_BAYES, PERCEPTRON, score, score_checkpoints,
)
from sieveline.operators import models as M
from sieveline.operators.naive_bayes import batch_updates, cumulative_models, model_table
from sieveline.operators.sharded import TASK_ROWS, ModelState, fit_batch, fit_batches, initial_state

SCHEMA = "batch_no long, row_in_batch int, y int, features array<struct<bucket int, x double>>"


def messages(n, batch=20, seed=3, separable=False):
    """Random unit vectors; class 1 leans to low buckets if separable."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.4)
        low, high = ((0, 200) if y else (200, 512)) if separable else (0, 512)
        buckets = sorted(rng.sample(range(low, high), rng.randint(0 if not separable else 3, 9)))
        tf = [rng.randint(1, 4) for _ in buckets]
        norm = math.sqrt(sum(t * t for t in tf)) or 1.0
        rows.append((i // batch + 1, i % batch, y, [(b, t / norm) for b, t in zip(buckets, tf)]))
    return rows


def dense(row):
    x = np.zeros(N_BUCKETS)
    for b, v in row[3]:
        x[b] = v
    return x


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def table(spark, states, key="batch_no", at=1):
    return spark.createDataFrame(
        [(at, m, s.params.tolist()) for m, s in states.items()], f"{key} long, model string, params array<double>"
    )


# Naive Bayes


def naive_bayes(rows):
    """Class sizes, smoothed log probabilities, from dense arrays."""
    n = [sum(r[2] == c for r in rows) for c in (0, 1)]
    sums = np.array([sum([dense(r) for r in rows if r[2] == c], np.zeros(N_BUCKETS)) for c in (0, 1)])
    logs = np.log(sums + 1) - np.log((sums + 1).sum(axis=1, keepdims=True))
    return n, logs


def test_naive_bayes_by_hand(spark):
    rows = [(1, 0, 1, [(0, 1.0)]), (1, 1, 0, [(1, 1.0)]), (1, 2, 0, [(1, 0.6), (2, 0.8)]), (1, 3, 0, [])]
    made = {(r.y, r.bucket): r for r in model_table(cumulative_models(frame(spark, rows))).collect()}
    assert len(made) == 2 * N_BUCKETS
    assert made[1, 0].log_prior == pytest.approx(math.log(1 / 4))
    assert made[0, 0].log_prior == pytest.approx(math.log(3 / 4))
    assert made[1, 0].log_likelihood == pytest.approx(math.log(2 / 513))
    assert made[0, 1].log_likelihood == pytest.approx(math.log(2.6 / 514.4))
    assert made[0, 511].log_likelihood == pytest.approx(math.log(1 / 514.4))


def test_one_pass_equals_batch_by_batch(spark):
    rows = messages(90)
    df = frame(spark, rows)
    cumulative = {r.batch_no: np.array(r.params) for r in cumulative_models(df).collect()}
    state = np.zeros(2 + 2 * N_BUCKETS)
    for b in range(1, 6):
        state = state + batch_updates(df.filter(F.col("batch_no") == b))[b]
        np.testing.assert_allclose(cumulative[b], state, atol=1e-12)
        n, logs = naive_bayes([r for r in rows if r[0] <= b])
        assert list(state[:2]) == n
    single = {r.batch_no: np.array(r.params) for r in cumulative_models(df, n_batches=5).collect()}
    for b in single:
        np.testing.assert_allclose(single[b], cumulative[b], atol=1e-12)


def test_naive_bayes_decision(spark):
    rows = messages(60, batch=60)
    n, logs = naive_bayes(rows)
    expected = [math.log(n[1]) - math.log(n[0]) + dense(r) @ (logs[1] - logs[0]) for r in rows]
    scored = score(frame(spark, rows), cumulative_models(frame(spark, rows)), ["batch_no"]).collect()
    for r in scored:
        assert r.decision == pytest.approx(expected[r.row_in_batch], abs=1e-9)
        assert r.prediction == int(expected[r.row_in_batch] > 1e-9)


@pytest.mark.parametrize("only", [0, 1])
def test_one_class_is_always_predicted(spark, only):
    rows = [(1, i, only, [(i, 1.0)]) for i in range(4)]
    scored = score(frame(spark, rows), cumulative_models(frame(spark, rows)), ["batch_no"]).collect()
    assert [r.prediction for r in scored] == [only] * 4


# Row-by-row learners, as loops over dense arrays


def logistic(rows, params):
    w, b = params[1:].copy(), params[0]
    for r in rows:
        x = dense(r)
        gradient = 1 / (1 + math.exp(-(w @ x + b))) - r[2]
        w, b = w - 0.01 * (gradient * x + 1e-4 * w), b - 0.01 * gradient
    return np.concatenate([[b], w])


def perceptron(rows, params):
    w, b = params[1:].copy(), params[0]
    for r in rows:
        x, sign = dense(r), 2 * r[2] - 1
        if sign * (w @ x + b) <= 0:
            w, b = w + sign * x, b + sign
    return np.concatenate([[b], w])


@pytest.mark.parametrize("model, loop", [(LOGISTIC, logistic), (PERCEPTRON, perceptron)])
def test_one_shard_is_the_sequential_rule(spark, model, loop):
    rows = messages(50, batch=50)
    start = initial_state(model)
    once = fit_batch(frame(spark, rows), {model: start}, 1)[model]
    np.testing.assert_allclose(once.params, loop(rows, start.params), atol=1e-12)
    twice = fit_batch(frame(spark, rows), {model: once}, 1)[model]
    np.testing.assert_allclose(twice.params, loop(rows, once.params), atol=1e-12)


@pytest.mark.parametrize("partitions", [1, 7])
def test_shards_are_averaged_by_size(spark, partitions):
    rows = messages(50, batch=50)
    start = {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON)}
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    made = fit_batch(df, start, 4)  # 13, 13, 12 and 12 rows
    for m, loop in ((LOGISTIC, logistic), (PERCEPTRON, perceptron)):
        parts = [[r for r in rows if r[1] % 4 == s] for s in range(4)]
        mean = sum(len(p) * loop(p, start[m].params) for p in parts) / 50
        np.testing.assert_allclose(made[m].params, mean, atol=1e-12)


@pytest.mark.parametrize("shards", [1, 3])
def test_batches_follow_one_another(spark, shards):
    rows = messages(90)
    start = {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON, MLP)}
    sizes = {b: sum(r[0] == b for r in rows) for b in range(1, 6)}
    made = fit_batches(frame(spark, rows), start, list(sizes), shards)
    state = start
    for b in sizes:
        state = fit_batch(frame(spark, [r for r in rows if r[0] == b]), state, shards)
        for m in state:
            np.testing.assert_allclose(made[b][m].params, state[m].params, atol=1e-12)
            assert made[b][m].steps == state[m].steps


def test_a_batch_costs_no_job_and_missing_ones_change_nothing(spark):
    """Five batches run as many jobs as one; a number without rows keeps the models."""
    df = frame(spark, messages(90)).persist()
    df.count()
    start = {m: initial_state(m) for m in (LOGISTIC, MLP)}
    jobs, made = {}, {}
    for order in ([1], [1, 2, 3, 4, 5], [1, 7, 9]):
        group = f"fit-{len(order)}"
        spark.sparkContext.setJobGroup(group, group)
        made[len(order)] = fit_batches(df.filter(F.col("batch_no").isin(order)), start, order, 4)
        jobs[len(order)] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] == jobs[5] <= 2
    for m in start:
        np.testing.assert_array_equal(made[3][9][m].params, made[3][1][m].params)
        np.testing.assert_array_equal(made[5][1][m].params, made[1][1][m].params)


def test_small_batches_wait_for_no_exchange(spark):
    """Sixty batches of two rows by four shards: well under a second each."""
    df = frame(spark, messages(120, batch=2)).persist()
    df.count()
    start = {m: initial_state(m) for m in (LOGISTIC, MLP)}
    fit_batches(df, start, [1, 2], 4)
    began = time.monotonic()
    made = fit_batches(df, start, list(range(1, 61)), 4)
    assert len(made) == 60 and time.monotonic() - began < 30


@pytest.mark.parametrize("large", [set(), {1}, {2, 3}, {1, 3, 5}, {1, 2, 3, 4, 5}])
def test_large_batches_between_small_ones(spark, large):
    """Shards in tasks of their own or in one task: the same models."""
    df = frame(spark, messages(90))
    start = {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON, MLP)}
    start[CLUSTERING] = ModelState(kmeans.initial_model(df.filter("batch_no = 1")))
    plain = fit_batches(df, start, [1, 2, 3, 4, 5], 3)
    made = fit_batches(df, start, [1, 2, 3, 4, 5], 3, {b: TASK_ROWS + (b in large) for b in range(1, 6)})
    for b in plain:
        for m in start:
            np.testing.assert_array_equal(made[b][m].params, plain[b][m].params)
    for m in start:
        np.testing.assert_array_equal(made[5][m].moments, plain[5][m].moments)


@pytest.mark.parametrize("n", [8191, 8192, 8193])
def test_no_size_changes_the_rule(spark, n):
    rows = messages(n, batch=n)
    start = initial_state(LOGISTIC)
    one = fit_batch(frame(spark, rows), {LOGISTIC: start}, 1)[LOGISTIC]
    np.testing.assert_allclose(one.params, logistic(rows, start.params), atol=1e-9)
    four = fit_batch(frame(spark, rows), {LOGISTIC: start}, 4)[LOGISTIC]
    parts = [[r for r in rows if r[1] % 4 == s] for s in range(4)]
    np.testing.assert_allclose(four.params, sum(len(p) * logistic(p, start.params) for p in parts) / n, atol=1e-9)


def test_network_shards_are_averaged(spark):
    rows = messages(50, batch=50)
    start = {MLP: initial_state(MLP)}
    made = fit_batch(frame(spark, rows), start, 2)[MLP]
    halves = [fit_batch(frame(spark, [r for r in rows if r[1] % 2 == s]), start, 1)[MLP] for s in (0, 1)]
    np.testing.assert_allclose(made.params, (halves[0].params + halves[1].params) / 2, atol=1e-12)
    np.testing.assert_allclose(made.moments, (halves[0].moments + halves[1].moments) / 2, atol=1e-12)
    assert made.steps == 1


def loss(params, rows):
    """Log loss plus L2 of the network, from its definition."""
    unit = 1 + N_BUCKETS
    w1 = params[:HIDDEN_UNITS * unit].reshape(HIDDEN_UNITS, unit)
    b2, w2 = params[HIDDEN_UNITS * unit], params[HIDDEN_UNITS * unit + 1:]
    total = 0.0
    for r in rows:
        p = 1 / (1 + math.exp(-(b2 + w2 @ np.tanh(w1[:, 0] + w1[:, 1:] @ dense(r)))))
        total -= math.log(p if r[2] else 1 - p)
    return (total + 0.5 * 1e-4 * ((w1[:, 1:] ** 2).sum() + (w2**2).sum())) / len(rows)


def test_network_gradient_by_differences():
    rows = messages(12)
    state = initial_state(MLP)
    data = [(np.array([b for b, _ in r[3]], dtype=int), np.array([v for _, v in r[3]])) for r in rows]
    gradient = sharded._network_gradient(state.params, data, np.array([r[2] for r in rows]))
    rng = np.random.RandomState(0)
    for i in [0, 513, len(state.params) - 16, len(state.params) - 1, *rng.randint(0, len(state.params), 20)]:
        up, down = state.params.copy(), state.params.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert gradient[i] == pytest.approx((loss(up, rows) - loss(down, rows)) / 2e-5, abs=1e-7)


def test_network_step_and_moments(spark):
    rows = messages(450, batch=450)
    start = initial_state(MLP)
    assert len(start.params) == 7711
    data = [(np.array([b for b, _ in r[3]], dtype=int), np.array([v for _, v in r[3]])) for r in rows]
    y = np.array([r[2] for r in rows])
    params, m, v = start.params.copy(), 0.0, 0.0
    for t, at in enumerate((0, 200, 400), 1):
        g = sharded._network_gradient(params, data[at:at + 200], y[at:at + 200])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - 0.001 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8 / math.sqrt(1 - 0.999**t))
    made = fit_batch(frame(spark, rows), {MLP: start}, 1)[MLP]
    assert made.steps == 3
    np.testing.assert_allclose(made.params, params, atol=1e-12)
    np.testing.assert_allclose(made.moments, np.concatenate([m, v]), atol=1e-12)


def test_network_decision(spark):
    rows = messages(30, batch=30)
    state = initial_state(MLP)
    unit = 1 + N_BUCKETS
    w1 = state.params[:HIDDEN_UNITS * unit].reshape(HIDDEN_UNITS, unit)
    b2, w2 = state.params[HIDDEN_UNITS * unit], state.params[HIDDEN_UNITS * unit + 1:]
    for r in score(frame(spark, rows), table(spark, {MLP: state}), ["batch_no"]).collect():
        x = dense(rows[r.row_in_batch])
        assert r.decision == pytest.approx(b2 + w2 @ np.tanh(w1[:, 0] + w1[:, 1:] @ x), abs=1e-12)


def test_every_learner_beats_the_majority(spark):
    rows = messages(600, batch=600, separable=True)
    df = frame(spark, rows).persist()
    states = {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON, MLP)}
    for _ in range(40):
        states = fit_batch(df, states, 1)
    states[NAIVE_BAYES] = ModelState(batch_updates(df)[1])
    measured = classification_metrics(score(df, table(spark, states), ["batch_no"]), ["model"]).collect()
    majority = max(sum(r[2] == c for r in rows) for c in (0, 1)) / 600
    assert len(measured) == 4
    assert all(r.accuracy > majority + 0.1 for r in measured), [(r.model, r.accuracy) for r in measured]


# Clustering


def closest(x, centres):
    d = [((x - c) ** 2).sum() for c in centres]
    return int(d[1] < d[0] - 1e-9)


def test_clusters_batch_by_batch(spark):
    rows = messages(90, batch=30)
    df = frame(spark, rows)
    at = lambda b: df.filter(F.col("batch_no") == b)
    model = kmeans.initial_model(at(1))
    first = [dense(r) for r in rows if r[0] == 1]
    gaps = [round(((x - first[0]) ** 2).sum(), 9) for x in first]
    centres = [first[0], first[gaps.index(max(gaps))]]
    np.testing.assert_allclose(model[2:], np.concatenate(centres))
    seen = [[], []]
    for b in (1, 2, 3):
        model = kmeans.update(at(b), model, b)
        xs = [dense(r) for r in rows if r[0] == b]
        for x, k in [(x, closest(x, centres)) for x in xs]:
            seen[k].append(x)
        centres = [np.mean(s, axis=0) if s else c for s, c in zip(seen, centres)]
        np.testing.assert_allclose(model[2:], np.concatenate(centres), atol=1e-12)
        assert list(model[:2]) == [len(s) for s in seen]
    made = {(r.batch_no, r.row_in_batch): r.prediction for r in kmeans.assign(at(3), model, 3).collect()}
    assert made == {(3, r[1]): closest(dense(r), centres) for r in rows if r[0] == 3}


def test_seeded_centres(spark):
    """By hand from the same chances; other partitions draw the same, other seeds others."""
    import hashlib

    rows = messages(60, batch=60)
    xs = [dense(r) for r in rows]
    u = lambda seed, turn, i: (int(hashlib.md5(f"{seed}:{turn}:{i}".encode()).hexdigest()[:8], 16) + 1) / 2**32
    drawn = set()
    for seed in range(4):
        made = kmeans.seeded_centres(frame(spark, rows).repartition(1 + 3 * seed), 3, seed)
        chosen = [min(range(60), key=lambda i: u(seed, 0, i))]
        for turn in (1, 2):
            gap = [min(round(((x - xs[c]) ** 2).sum(), 9) for c in chosen) for x in xs]
            chosen.append(min((i for i in range(60) if gap[i] > 0), key=lambda i: -math.log(u(seed, turn, i)) / gap[i]))
        for c, i in zip(made, chosen):
            np.testing.assert_array_equal(c, xs[i])
        drawn.add(tuple(chosen))
    assert len(drawn) > 1
    same = [(1, i, 0, [(3, 1.0)]) for i in range(4)]
    first, second = kmeans.seeded_centres(frame(spark, same), 2, 1)
    np.testing.assert_array_equal(first, second)


@pytest.mark.parametrize("shards", [1, 4])
def test_clusters_do_not_depend_on_shards(spark, shards):
    df = frame(spark, messages(90, batch=30))
    start = kmeans.initial_model(df.filter(F.col("batch_no") == 1))
    made = fit_batches(df, {CLUSTERING: ModelState(start)}, [1, 2, 3], shards)
    params = start
    for b in (1, 2, 3):
        params = kmeans.update(df.filter(F.col("batch_no") == b), params, b)
        np.testing.assert_allclose(made[b][CLUSTERING].params, params, atol=1e-12)


def test_a_tie_goes_to_the_first_centre(spark):
    params = np.zeros(2 + 2 * N_BUCKETS)
    params[2 + 0], params[2 + N_BUCKETS + 1] = 1.0, 1.0
    rows = [(1, 0, 0, [(0, 0.6), (1, 0.6)]), (1, 1, 0, []), (1, 2, 0, [(1, 0.5)])]
    made = {r.row_in_batch: r.prediction for r in kmeans.assign(frame(spark, rows), params, 1).collect()}
    assert made == {0: 0, 1: 0, 2: 1}
    moved = fit_batches(frame(spark, rows), {CLUSTERING: ModelState(params)}, [1])
    assert list(moved[1][CLUSTERING].params[:2]) == [2, 1]


def test_a_starved_centre_stays(spark):
    params = np.zeros(2 + 2 * N_BUCKETS)
    params[2 + 0], params[2 + N_BUCKETS + 1] = 1.0, 5.0
    moved = kmeans.update(frame(spark, [(1, 0, 0, [(0, 0.5)])]), params, 1)
    one = fit_batches(frame(spark, [(1, 0, 0, [(0, 0.5)])]), {CLUSTERING: ModelState(params)}, [1])
    np.testing.assert_array_equal(one[1][CLUSTERING].params, moved)
    assert list(moved[:2]) == [1, 0] and moved[2] == 0.5 and moved[2 + N_BUCKETS + 1] == 5.0


# Scoring several checkpoints


def test_checkpoints_in_groups(spark, monkeypatch):
    rows = messages(20)
    states = [(b, LOGISTIC, [float(b % 2) - 0.5] + [0.0] * N_BUCKETS) for b in range(1, 6)]
    models = spark.createDataFrame(states, "batch_no long, model string, params array<double>")
    wide = score_checkpoints(frame(spark, rows), models, [1, 2, 4]).collect()
    monkeypatch.setattr(M, "BROADCAST_LIMIT", 1)
    narrow = score_checkpoints(frame(spark, rows), models, [4, 2, 1]).collect()
    key = lambda r: (r.checkpoint, r.row_in_batch, r.prediction)
    assert sorted(map(key, wide)) == sorted(map(key, narrow))
    assert {(r.checkpoint, r.prediction) for r in wide} == {(1, 1), (2, 0), (4, 0)}
    with pytest.raises(ValueError):
        score_checkpoints(frame(spark, rows), models, [])


@pytest.mark.parametrize("block_bytes, block_rows", [(C.BLOCK_BYTES, C.BLOCK_ROWS), (200_000, 7)])
def test_counts_by_blocks_equal_counts_of_scores(spark, monkeypatch, block_bytes, block_rows):
    """Every kind of model, classes without rows, and rows without words."""
    monkeypatch.setattr(C, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(C, "BLOCK_ROWS", block_rows)
    rows = messages(90)
    df = frame(spark, rows)
    order = [1, 2, 3, 4, 5]
    learnt = {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON, MLP)}
    learnt[CLUSTERING] = ModelState(kmeans.initial_model(df.filter("batch_no = 1")))
    after = fit_batches(df, learnt, order, 2)
    sums = batch_updates(df)
    for b in order:
        after[b][NAIVE_BAYES] = ModelState(sum(sums[i] for i in order if i <= b))
    one_class = np.append([5.0, 0.0], np.ones(2 * N_BUCKETS))
    table = [(m, b, s.params.tolist()) for b in order for m, s in after[b].items()]
    table += [(NAIVE_BAYES, 6, one_class.tolist()), (NAIVE_BAYES, 7, one_class[[1, 0, *range(2, 2 + 2 * N_BUCKETS)]].tolist())]
    models = spark.createDataFrame(table, "model string, checkpoint long, params array<double>")
    ided = df.withColumn("row_id", F.col("batch_no") * 100 + F.col("row_in_batch"))
    made = C.checkpoint_counts(ided, models).collect()
    scored = score_checkpoints(ided, models.withColumnRenamed("checkpoint", "batch_no"), [*order, 6, 7])
    expected = confusion_counts(scored, ["model", "checkpoint"]).collect()
    columns = ("model", "checkpoint", "n", "tp", "fp", "fn", "tn")
    assert sorted(tuple(r[c] for c in columns) for r in made) == sorted(tuple(r[c] for c in columns) for r in expected)
    assert C.checkpoint_counts(ided.limit(0), models).count() == 0


def test_checkpoints_are_scored_by_products(spark, monkeypatch):
    """The values of the expressions in every kind of model, without one in the plan, whatever the rows hold."""
    rows = messages(60)
    df = frame(spark, rows).withColumn("y", F.when(F.col("row_in_batch") != 3, F.col("y"))).withColumn("note", F.lit("a"))
    learnt = {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON, MLP)}
    learnt[CLUSTERING] = ModelState(kmeans.initial_model(df.filter("batch_no = 1")))
    sums = batch_updates(frame(spark, rows))
    after = {b: {**s, NAIVE_BAYES: ModelState(sums[b])} for b, s in fit_batches(frame(spark, rows), learnt, sorted(sums), 2).items()}
    table = [(m, b, s.params.tolist()) for b in after for m, s in after[b].items()]
    models = spark.createDataFrame(table, "model string, batch_no long, params array<double>")
    asked = [b for b in after if b != 2]
    listed = df.crossJoin(spark.createDataFrame([(b,) for b in asked], "checkpoint long"))
    renamed = models.withColumnRenamed("batch_no", "checkpoint")
    told = score(listed, renamed, ["checkpoint"], broadcast=False)
    monkeypatch.setattr(M, "score", lambda *_, **__: pytest.fail("row by row"))
    made = score_checkpoints(df, models, asked)
    assert made.columns == told.columns and "note" in made.columns
    key = lambda r: (r.model, r.checkpoint, r.batch_no, r.row_in_batch)
    made, told = sorted(made.collect(), key=key), sorted(told.collect(), key=key)
    assert [(*key(r), r.note, r.truth, r.prediction) for r in made] == [(*key(r), r.note, r.truth, r.prediction) for r in told]
    assert [r.decision for r in made] == pytest.approx([r.decision for r in told], abs=1e-9)
    assert len({r.model for r in made}) == 5 and any(r.truth is None for r in made)


def test_sent_models_score_by_products(spark):
    """Few models are sent as matrices, to the values of the join; rows without a key find none."""
    rows = messages(40)
    df = frame(spark, rows).withColumn("tag", F.lit("t")).withColumn("x", F.col("features"))
    df = df.unionByName(df.limit(3).withColumn("batch_no", F.lit(None).cast("long"))).unionByName(
        df.limit(2).withColumn("features", F.lit(None).cast(df.schema["features"].dataType))
    )
    learnt = {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON, MLP)}
    after = fit_batches(frame(spark, rows), learnt, sorted({r[0] for r in rows}), 2)
    table = [(m, b, s.params.tolist()) for b in after for m, s in after[b].items()] + [(LOGISTIC, None, [0.0] * (1 + N_BUCKETS))]
    models = spark.createDataFrame(table, "model string, batch_no long, params array<double>")
    made, told = score(df, models, ["batch_no"]), score(df, models, ["batch_no"], broadcast=False)
    assert "hidden" not in made._jdf.queryExecution().optimizedPlan().toString() and made.columns == told.columns
    key = lambda r: (r.model, r.batch_no, r.row_in_batch, r.decision is None, r.tag, r.truth)
    made, told = sorted(made.collect(), key=key), sorted(told.collect(), key=key)
    assert [(*key(r), r.prediction, r.x) for r in made] == [(*key(r), r.prediction, r.x) for r in told] and None in {r.decision for r in made}
    assert [r.decision for r in made if r.x and r.decision is not None] == pytest.approx(
        [r.decision for r in told if r.x and r.decision is not None], abs=1e-9
    )


# Metrics


def pairs(spark, rows):
    return spark.createDataFrame(rows, "g int, truth int, prediction int")


def test_empty_denominators_give_zero(spark):
    df = pairs(spark, [(1, 1, 0), (1, 0, 0), (2, 0, 1), (2, 0, 0), (3, 1, 1)])
    made = {r.g: (r.accuracy, r.precision, r.recall) for r in classification_metrics(df, ["g"]).collect()}
    assert made == {1: (0.5, 0.0, 0.0), 2: (0.5, 0.0, 0.0), 3: (1.0, 1.0, 1.0)}


def test_metrics_agree_with_each_other(spark):
    rng = random.Random(5)
    df = pairs(spark, [(i % 3, rng.randint(0, 1), rng.randint(0, 1)) for i in range(200)])
    plain = {r.g: r for r in classification_metrics(df, ["g"]).collect()}
    both = {r.g: r for r in dual_polarity(confusion_counts(df, ["g"])).collect()}
    flipped = {r.g: r for r in classification_metrics(df.withColumn("truth", 1 - F.col("truth")), ["g"]).collect()}
    inverted = {r.g: r for r in classification_metrics(invert_predictions(df), ["g"]).collect()}
    wrong = {r.g: r.error_rate for r in error_rate(df, ["g"]).collect()}
    for g in range(3):
        assert both[g].accuracy_spam_1 == plain[g].accuracy == pytest.approx(1 - wrong[g])
        assert both[g].accuracy_spam_0 == flipped[g].accuracy == inverted[g].accuracy == pytest.approx(wrong[g])
        for m in ("precision", "recall"):
            assert both[g][f"{m}_spam_0"] == flipped[g][m] and both[g][f"{m}_spam_1"] == plain[g][m]
    counted = {(r.g, r.truth, r.prediction): r.n for r in confusion_matrix(df, ["g"]).collect()}
    assert counted[0, 1, 1] == plain[0].tp and counted[0, 0, 1] == plain[0].fp

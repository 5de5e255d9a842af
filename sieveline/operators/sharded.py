"""Learners that go through batches one after another, in a stated number of shards.

A batch is dealt into ``shards`` by its row numbers.  Every shard starts from the
current model, makes one pass over its rows in order, and the parameters are averaged
by shard size (parameter mixing, McDonald et al. 2010; Zinkevich et al. 2010); the
clusterer's shards add up sums instead.  One shard is the sequential rule itself.
The number is an argument that is kept with the models; neither the size of a batch
nor the cluster has a part in the results.

A batch of up to ``TASK_ROWS`` rows is a few milliseconds of work, less than any exchange
between tasks takes: one task has all shards of consecutive small batches and meets
after each.  The shards of a larger batch are learnt by tasks of their own, a
stage for the batch, and the driver averages them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import N_BUCKETS
from .models import CLUSTERING, HIDDEN_UNITS, LOGISTIC, MLP, PERCEPTRON, TIE

SHARDS = 4

# Settings of the learners.
LOGISTIC_STEP, L2 = 0.01, 1e-4
ADAM_STEP, ADAM_BETA_1, ADAM_BETA_2, ADAM_EPSILON = 0.001, 0.9, 0.999, 1e-8
MLP_SEED, MLP_BATCH = 1, 200

UNIT = 1 + N_BUCKETS
MLP_SIZE = HIDDEN_UNITS * UNIT + 1 + HIDDEN_UNITS


@dataclass(frozen=True)
class ModelState:
    """Parameters of a model and what its optimiser carries along."""

    params: np.ndarray
    moments: np.ndarray = field(default_factory=lambda: np.zeros(0))
    steps: int = 0


def initial_state(model: str) -> ModelState:
    if model == MLP:
        return ModelState(_initial_network(), np.zeros(2 * MLP_SIZE))
    return ModelState(np.zeros(1 + N_BUCKETS))


def _initial_network() -> np.ndarray:
    """Uniform start scaled to the layer widths (Glorot and Bengio 2010)."""
    rng = np.random.RandomState(MLP_SEED)
    layers = []
    for fan_in, fan_out in ((N_BUCKETS, HIDDEN_UNITS), (HIDDEN_UNITS, 1)):
        bound = np.sqrt(6.0 / (fan_in + fan_out))
        weights = rng.uniform(-bound, bound, (fan_in, fan_out))
        intercepts = rng.uniform(-bound, bound, fan_out)
        layers.append(np.vstack([intercepts, weights]).T)
    return np.concatenate([layer.ravel() for layer in layers])


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def logistic_pass(state: ModelState, rows, y) -> ModelState:
    """Log loss with L2 decay, one step of fixed length per row."""
    w, b = state.params[1:].copy(), state.params[0]
    for (buckets, x), target in zip(rows, y):
        error = _sigmoid(x @ w[buckets] + b) - target
        w *= 1.0 - LOGISTIC_STEP * L2
        w[buckets] -= LOGISTIC_STEP * error * x
        b -= LOGISTIC_STEP * error
    return replace(state, params=np.concatenate([[b], w]))


def perceptron_pass(state: ModelState, rows, y) -> ModelState:
    """A unit step for every row that is not on its side of the boundary."""
    w, b = state.params[1:].copy(), state.params[0]
    for (buckets, x), target in zip(rows, y):
        sign = 2 * target - 1
        if sign * (x @ w[buckets] + b) <= 0:
            w[buckets] += sign * x
            b += sign
    return replace(state, params=np.concatenate([[b], w]))


def network_pass(state: ModelState, rows, y) -> ModelState:
    """Adam on the log loss with L2, in mini-batches of consecutive rows."""
    params, steps = state.params.copy(), state.steps
    mean, square = state.moments[:MLP_SIZE].copy(), state.moments[MLP_SIZE:].copy()
    for start in range(0, len(rows), MLP_BATCH):
        part, target = rows[start:start + MLP_BATCH], y[start:start + MLP_BATCH]
        gradient = _network_gradient(params, part, target)
        steps += 1
        mean = ADAM_BETA_1 * mean + (1 - ADAM_BETA_1) * gradient
        square = ADAM_BETA_2 * square + (1 - ADAM_BETA_2) * gradient**2
        rate = ADAM_STEP * np.sqrt(1 - ADAM_BETA_2**steps) / (1 - ADAM_BETA_1**steps)
        params -= rate * mean / (np.sqrt(square) + ADAM_EPSILON)
    return ModelState(params, np.concatenate([mean, square]), steps)


def _network_gradient(params: np.ndarray, rows, y) -> np.ndarray:
    n = len(rows)
    x = np.zeros((n, UNIT))
    x[:, 0] = 1.0
    for i, (buckets, values) in enumerate(rows):
        x[i, buckets + 1] = values
    hidden = params[:HIDDEN_UNITS * UNIT].reshape(HIDDEN_UNITS, UNIT)
    output = params[HIDDEN_UNITS * UNIT:]
    h = np.tanh(x @ hidden.T)
    error = _sigmoid(h @ output[1:] + output[0]) - y
    back = error[:, None] * output[1:] * (1 - h**2)
    grad_hidden, grad_output = back.T @ x, np.concatenate([[error.sum()], h.T @ error])
    grad_hidden[:, 1:] += L2 * hidden[:, 1:]
    grad_output[1:] += L2 * output[1:]
    return np.concatenate([grad_hidden.ravel(), grad_output]) / n


PASSES = {LOGISTIC: logistic_pass, PERCEPTRON: perceptron_pass, MLP: network_pass}


def cluster_sums(params: np.ndarray, rows) -> np.ndarray:
    """Sizes and bucket sums of the rows nearest to each of two centres, laid out as the model is."""
    first, second = params[2:2 + N_BUCKETS], params[2 + N_BUCKETS:]
    bias, weights = first @ first - second @ second, 2 * (second - first)
    added = np.zeros(2 + 2 * N_BUCKETS)
    for buckets, x in rows:
        nearest = int(bias + x @ weights[buckets] > TIE)
        added[nearest] += 1
        added[2 + nearest * N_BUCKETS + buckets] += x
    return added


def moved_centres(params: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Each centre as the mean of all rows it has been given so far; a starved one stays."""
    moved = params.copy()
    for k in (0, 1):
        at = slice(2 + k * N_BUCKETS, 2 + (k + 1) * N_BUCKETS)
        weight = params[k] + added[k]
        if weight > 0:
            moved[at] = (params[k] * params[at] + added[at]) / weight
        moved[k] = weight
    return moved


#: Rows of a batch whose shards one task takes in turn.
TASK_ROWS = 1 << 13

#: Rows that a shard holds at a time: whole mini-batches of the network.
PIECE = 10 * MLP_BATCH


def fit_batches(
    rows: DataFrame, states: dict[str, ModelState], order: Sequence[int], shards: int = SHARDS,
    sizes: dict[int, int] | None = None,
) -> dict[int, dict[str, ModelState]]:
    """The given models after each batch, batches taken in ``order``, which rises.

    ``rows`` has ``batch_no, row_in_batch, y, features``; ``sizes`` are its rows by batch.
    Without them a single batch counts as large, and several as small.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    after: dict[int, dict[str, ModelState]] = {}
    current = dict(states)
    is_large = lambda number: sizes.get(number, 0) > TASK_ROWS if sizes else len(order) == 1
    for large, numbers in groupby(order, key=is_large):
        if large:
            for number in numbers:
                current = after[number] = _meet(current, _apart(rows, current, number, shards))
        else:
            after |= _in_turn(rows, current, list(numbers), shards)
            current = after[max(after)]
    return after


def fit_batch(rows: DataFrame, states: dict[str, ModelState], shards: int = SHARDS) -> dict[str, ModelState]:
    """:func:`fit_batches` for a table that is one batch."""
    one = rows.withColumn("batch_no", F.lit(1).cast("long"))
    return fit_batches(one, states, [1], shards)[1]


def _dealt(rows: DataFrame, shards: int, tasks: int) -> DataFrame:
    """Rows in order of batches and shards, a shard in one of so many tasks."""
    dealt = rows.select(
        F.pmod("row_in_batch", F.lit(shards)).cast("int").alias("shard"), "batch_no", "row_in_batch", "y",
        F.col("features.bucket").alias("buckets"), F.col("features.x").alias("xs"),
    )
    dealt = dealt.repartitionById(tasks, F.pmod("shard", F.lit(tasks))).sortWithinPartitions("batch_no", "shard", "row_in_batch")
    return dealt.select("batch_no", "shard", "y", "buckets", "xs")


def _in_turn(
    rows: DataFrame, states: dict[str, ModelState], order: list[int], shards: int
) -> dict[int, dict[str, ModelState]]:
    """Every model after every one of some small batches, by one task that has all shards.

    The models are small and travel with the task.  Rows stream by in order and are
    taken in pieces, so the task holds a piece however many batches there are.  What an
    optimiser carries along comes with the last of them alone.
    """
    def learn(frames):
        feed = groupby(_in_order(frames), key=lambda r: r[0])
        batch_no, own = next(feed, (None, None))
        current = dict(states)
        for number in order:
            if batch_no == number:
                current = _meet(current, [_pass(current, dealt) for _, dealt in groupby(own, key=lambda r: r[1])])
                batch_no, own = next(feed, (None, None))
            numbers = lambda s: np.concatenate([s.params, s.moments]) if number == order[-1] else s.params
            yield pd.DataFrame(
                [(number, m, s.steps, numbers(s)) for m, s in current.items()], columns=["batch_no", "model", "steps", "numbers"]
            )

    asked = rows.filter(F.col("batch_no").between(order[0], order[-1]))
    made = _dealt(asked, shards, 1).mapInPandas(learn, "batch_no long, model string, steps long, numbers array<double>").toArrow()
    after: dict[int, dict[str, ModelState]] = {number: {} for number in order}
    for number, model, steps, numbers in zip(*(made[c] for c in ("batch_no", "model", "steps", "numbers"))):
        after[number.as_py()][model.as_py()] = _state(model.as_py(), steps.as_py(), numbers.values.to_numpy())
    return after


def _apart(
    rows: DataFrame, states: dict[str, ModelState], number: int, shards: int
) -> list[tuple[int, dict[str, ModelState]]]:
    """Size and models of every shard of a large batch, learnt by tasks of their own."""
    def learn(frames):
        for shard, dealt in groupby(_in_order(frames), key=lambda r: r[1]):
            n, learnt = _pass(states, dealt)
            yield pd.DataFrame(
                [(shard, n, m, s.steps, np.concatenate([s.params, s.moments])) for m, s in learnt.items()],
                columns=["shard", "n", "model", "steps", "numbers"],
            )

    tasks = min(shards, rows.sparkSession.sparkContext.defaultParallelism)
    made = _dealt(rows.filter(F.col("batch_no") == number), shards, tasks).mapInPandas(
        learn, "shard int, n long, model string, steps long, numbers array<double>"
    ).toArrow()  # a row per shard and model
    parts: dict[int, tuple[int, dict[str, ModelState]]] = {}
    for shard, n, model, steps, numbers in zip(*(made[c] for c in ("shard", "n", "model", "steps", "numbers"))):
        learnt = parts.setdefault(shard.as_py(), (n.as_py(), {}))[1]
        learnt[model.as_py()] = _state(model.as_py(), steps.as_py(), numbers.values.to_numpy())
    return [parts[shard] for shard in sorted(parts)]


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for frame in frames:
        yield from frame.itertuples(index=False, name=None)


def _pass(states: dict[str, ModelState], dealt: Iterator[tuple]) -> tuple[int, dict[str, ModelState]]:
    """Rows of a shard, and every model after them; for the clusterer, their sums."""
    current = {m: replace(s, params=np.zeros_like(s.params)) if m == CLUSTERING else s for m, s in states.items()}
    n, held = 0, []

    def take():
        data, y = [(b, x) for b, x, _ in held], np.array([y for _, _, y in held])
        for m, s in current.items():
            if m == CLUSTERING:
                current[m] = replace(s, params=s.params + cluster_sums(states[m].params, data))
            else:
                current[m] = PASSES[m](s, data, y)
        held.clear()

    for _, _, y, buckets, xs in dealt:
        held.append((np.asarray(buckets, dtype=np.int64), np.asarray(xs, dtype=float), y))
        n += 1
        if len(held) == PIECE:
            take()
    if held:
        take()
    return n, current


def _state(model: str, steps: int, numbers) -> ModelState:
    numbers = np.array(numbers)
    size = MLP_SIZE if model == MLP else len(numbers)  # only the network has moments
    return ModelState(numbers[:size], numbers[size:], steps)


def _meet(before: dict[str, ModelState], parts: list[tuple[int, dict[str, ModelState]]]) -> dict[str, ModelState]:
    """The models after a batch from those of its shards, in order of the shards: the
    mean weighted by rows, or the centres moved by the sum."""
    after = dict(before)
    n = sum(size for size, _ in parts)
    for model in before if parts else ():
        own = [(size, states[model]) for size, states in parts]
        if model == CLUSTERING:
            added = sum(s.params for _, s in own)
            after[model] = replace(before[model], params=moved_centres(before[model].params, added))
        elif len(own) == 1:
            after[model] = own[0][1]
        else:
            after[model] = ModelState(
                sum(size * s.params for size, s in own) / n, sum(size * s.moments for size, s in own) / n,
                round(sum(size * s.steps for size, s in own) / n),
            )
    return after

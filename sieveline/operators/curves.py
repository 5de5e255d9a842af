"""Confusion counts of many checkpoints at once, by products of blocks.

Checkpoints are laid out as matrices, a column per linear decider and one per hidden unit
of a network.  Rows and checkpoints are cut into blocks of bounded bytes; every block
of rows meets every block of checkpoints in a task, which multiplies them and gives
only four counts per checkpoint.  No table of rows times checkpoints exists, neither in
a shuffle nor in a task, unless every decision is asked for; then they leave the task as
they are made.  The work is rows times checkpoints by its definition; what is
moved is the rows once per block of checkpoints.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import N_BUCKETS
from .models import CLUSTERING, HIDDEN_UNITS, MLP, NAIVE_BAYES, TIE

#: Bytes of the matrices of a block of checkpoints, rows of a block and rows multiplied at a time.
BLOCK_BYTES, BLOCK_ROWS, STRIP = 16 << 20, 16_384, 512
#: Decisions of a row under a checkpoint that a task gives out at a time, or those of one row.
STRIP_DECISIONS = 1 << 17

_UNIT = 1 + N_BUCKETS
_COUNTS = "model string, checkpoint long, n long, tp long, fp long, fn long, tn long"


def linear_decider(model: str, params: np.ndarray) -> np.ndarray:
    """Bias and 512 weights of a model that decides by ``bias + weights . x``."""
    if model == NAIVE_BAYES:
        n0, n1 = params[:2]
        sums = params[2:].reshape(2, N_BUCKETS) + 1
        logs = np.log(sums) - np.log(sums.sum(axis=1, keepdims=True))
        # A class that has no rows yet is never predicted.
        prior = -np.inf if n1 == 0 else np.inf if n0 == 0 else np.log(n1) - np.log(n0)
        return np.append(prior, logs[1] - logs[0])
    if model == CLUSTERING:
        first, second = params[2:].reshape(2, N_BUCKETS)
        return np.append(first @ first - second @ second, 2 * (second - first))
    return params


class Deciders:
    """A block of checkpoints as matrices."""

    def __init__(self, models: list[tuple[str, int, np.ndarray]]):
        linear = [m for m in models if m[0] != MLP]
        networks = [m for m in models if m[0] == MLP]
        self.names = [m[:2] for m in linear + networks]
        weights = np.array([linear_decider(m, p) for m, _, p in linear]).reshape(-1, _UNIT)
        self.bias, self.weights = weights[:, 0], np.ascontiguousarray(weights[:, 1:].T)
        params = np.array([p for _, _, p in networks]).reshape(-1, HIDDEN_UNITS * _UNIT + 1 + HIDDEN_UNITS)
        hidden = params[:, :HIDDEN_UNITS * _UNIT].reshape(-1, _UNIT)
        self.hidden_bias, self.hidden = hidden[:, 0], np.ascontiguousarray(hidden[:, 1:].T)
        self.output = params[:, HIDDEN_UNITS * _UNIT:]
        self.counts = np.zeros((len(self.names), 4), dtype=np.int64)

    def decisions(self, x: np.ndarray) -> np.ndarray:
        """The decision value of some dense rows under every checkpoint."""
        decided = x @ self.weights + self.bias
        if len(self.output):
            h = np.tanh(x @ self.hidden + self.hidden_bias).reshape(len(x), -1, HIDDEN_UNITS)
            decided = np.hstack([decided, (h * self.output[:, 1:]).sum(axis=2) + self.output[:, 0]])
        return decided

    def says(self, x: np.ndarray) -> np.ndarray:
        """Whether every checkpoint puts some dense rows into class 1."""
        return self.decisions(x) > TIE

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        """Count what every checkpoint makes of some dense rows."""
        said, true = self.says(x), (y == 1)[:, None]
        pairs = (said & true, said & ~true, ~said & true, ~said & ~true)
        self.counts += np.stack([p.sum(axis=0) for p in pairs], axis=1)


def _meetings(
    rows: DataFrame, models: DataFrame, keep: Sequence[str] = (), block_bytes: int | None = None
) -> tuple[DataFrame, list[str]]:
    """Every block of rows with every block of checkpoints, models first, in a partition, and the
    names of the models."""
    n_rows = rows.count()
    sizes = models.groupBy("checkpoint").agg(F.sum(F.size("params")).alias("n"), F.array_sort(F.collect_set("model")).alias("names"))
    n_checkpoints, per_checkpoint, names = sizes.agg(
        F.count("*"), F.max("n"), F.array_distinct(F.flatten(F.collect_set("names")))
    ).first()
    n_blocks = max(1, min(n_checkpoints, -(-n_checkpoints * (per_checkpoint or 1) * 8 // (block_bytes or BLOCK_BYTES))))
    n_parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // BLOCK_ROWS))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    matrices = models.select(
        dealt(n_blocks, "checkpoint").alias("block"), each(n_parts).alias("part"), F.lit(0).alias("kind"), "model",
        "checkpoint", "params", F.lit(None).cast("int").alias("y"), F.lit(None).cast("array<int>").alias("buckets"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(f"kept_{c}") for c in keep],
    )
    vectors = rows.select(
        each(n_blocks).alias("block"), dealt(n_parts, *(keep or ["row_id"])).alias("part"), F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("model"), F.lit(None).cast("long").alias("checkpoint"),
        F.col("features.x").alias("params"), F.col("y").cast("int"), F.col("features.bucket").cast("array<int>").alias("buckets"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    tasks = matrices.unionByName(vectors).repartition(n_blocks * n_parts, "block", "part")
    return tasks.sortWithinPartitions("block", "part", "kind", "model", "checkpoint"), names or []


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Deciders, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """The checkpoints of a block with strips of its rows: dense, their classes, and as they came."""
    task, held, deciders = None, [], None
    for batch in batches:
        block, part, kind = (batch.column(n).to_numpy() for n in ("block", "part", "kind"))
        params = batch.column("params")
        values, ends = params.values.to_numpy(), params.offsets.to_numpy()
        edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
        for low, high in zip(np.append(0, edges), np.append(edges, batch.num_rows)):
            if (block[low], part[low]) != task:
                task, held, deciders = (block[low], part[low]), [], None
            if not kind[low]:
                names = zip(batch.column("model")[low:high].to_pylist(), batch.column("checkpoint")[low:high].to_pylist())
                held += [(*name, values[ends[i]:ends[i + 1]].copy()) for name, i in zip(names, range(low, high))]
                continue
            if deciders is None:
                deciders, held = Deciders(held), []
            y = batch.column("y").to_numpy(zero_copy_only=False)
            buckets = batch.column("buckets")
            slots, starts = buckets.values.to_numpy(), buckets.offsets.to_numpy()
            for start in range(low, high, STRIP):
                upto = min(start + STRIP, high)
                x = np.zeros((upto - start, N_BUCKETS))
                row = np.repeat(np.arange(upto - start), np.diff(ends[start:upto + 1]))
                x[row, slots[starts[start]:starts[upto]]] = values[ends[start]:ends[upto]]
                yield deciders, x, y[start:upto], batch.slice(start, upto - start)


def checkpoint_counts(rows: DataFrame, models: DataFrame) -> DataFrame:
    """``model, checkpoint, n, tp, fp, fn, tn`` of ``rows`` (``row_id, y, features``) under every row
    of ``models`` (``model, checkpoint, params``)."""
    def multiply(batches):
        counting = None
        for deciders, x, y, _ in _strips(batches):
            if counting is not None and counting is not deciders:
                yield report(counting)
            counting = deciders
            deciders.add(x, y)
        if counting is not None:
            yield report(counting)

    def report(deciders):
        found = [(*name, *c) for name, c in zip(deciders.names, deciders.counts.tolist())]
        return pa.RecordBatch.from_pydict({
            "model": pa.array([f[0] for f in found], type=pa.string()), "checkpoint": pa.array([f[1] for f in found], type=pa.int64()),
            "n": pa.array([sum(f[2:]) for f in found], type=pa.int64()),
            **{c: pa.array([f[2 + i] for f in found], type=pa.int64()) for i, c in enumerate(("tp", "fp", "fn", "tn"))},
        })

    counted = _meetings(rows, models)[0].mapInArrow(multiply, _COUNTS)
    return counted.groupBy("model", "checkpoint").agg(*[F.sum(c).alias(c) for c in ("n", "tp", "fp", "fn", "tn")])


def checkpoint_decisions(rows: DataFrame, models: DataFrame, keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """``model, checkpoint, truth, prediction`` and the integer columns in ``keep`` of every one of
    ``rows`` (``row_id, y, features``) under every row of ``models``."""
    return every_decision(rows.withColumns({c: F.col(c).cast("long") for c in keep}), models, keep)


def every_decision(
    rows: DataFrame, models: DataFrame, keep: Sequence[str], values: bool = False, block_bytes: int | None = None
) -> DataFrame:
    """``model, checkpoint, truth, prediction`` and the columns in ``keep`` of every one of ``rows``
    (``y, features``) under every row of ``models``, with ``values`` the ``decision`` too."""
    tasks, names = _meetings(rows, models, keep, block_bytes)
    code = {name: i for i, name in enumerate(names)}

    def decide(batches):
        for deciders, x, _, came in _strips(batches):
            n = len(deciders.names)
            at = max(1, STRIP_DECISIONS // max(n, 1))
            codes = np.array([code[m] for m, _ in deciders.names], dtype=np.int32)
            checkpoints = np.array([c for _, c in deciders.names], dtype=np.int64)
            for low in range(0, len(x), at):
                decided = deciders.decisions(x[low:low + at])
                row = pa.array(np.repeat(np.arange(low, low + len(decided)), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(codes, len(decided))), pa.array(np.tile(checkpoints, len(decided))), came.column("y").take(row),
                     pa.array((decided > TIE).ravel().astype(np.int32)), *([pa.array(decided.ravel())] if values else []),
                     *[came.column(f"kept_{c}").take(row) for c in keep]],
                    names=layout.names,
                )

    # Names are put in by number, so a decision leaves its task without text.
    layout = T.StructType([
        T.StructField("code", T.IntegerType()), T.StructField("checkpoint", T.LongType()), T.StructField("truth", T.IntegerType()),
        T.StructField("prediction", T.IntegerType()), *([T.StructField("decision", T.DoubleType())] if values else []),
        *[T.StructField(f"kept_{c}", rows.schema[c].dataType) for c in keep],
    ])
    name = F.element_at(F.array(*[F.lit(m) for m in names]).cast("array<string>"), F.col("code") + 1)
    made = tasks.mapInArrow(decide, layout)
    return made.select(
        name.alias("model"), "checkpoint", "truth", "prediction", *(["decision"] if values else []), *[F.col(f"kept_{c}").alias(c) for c in keep]
    )


def decisions_by_key(rows: DataFrame, models: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every row (``y, features``) with ``decision`` and ``prediction`` under every model that shares its
    ``on`` columns, ``y`` renamed to ``truth``.  The models are few: the driver sends them to all tasks."""
    table = models.select(*on, "model", "params").toArrow()
    keys = list(zip(*(table[c].to_pylist() for c in on)))
    own: dict[tuple, list] = {}
    for key, model, params in zip(keys, table["model"].to_pylist(), table["params"]):
        if None not in key:
            own.setdefault(key, []).append((model, 0, params.values.to_numpy()))
    sent = rows.sparkSession.sparkContext.broadcast(own)
    others = [c for c in rows.columns if c not in (*on, "features")]

    def decide(batches):
        at, deciders = None, None
        for batch in batches:
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in on))):
                places.setdefault(key, []).append(i)
            for key in sorted(k for k in places if k in sent.value):
                if key != at:
                    at, deciders = key, Deciders(sent.value[key])
                n = len(deciders.names)
                for low in range(0, len(places[key]), STRIP):
                    part = batch.take(pa.array(places[key][low:low + STRIP]))
                    decided = deciders.decisions(_dense(part.column("features"))).ravel()
                    empty = np.repeat(part.column("features").is_null().to_numpy(zero_copy_only=False), n)
                    row = pa.array(np.repeat(np.arange(part.num_rows), n))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c).take(row) for c in (*on, *others)),
                         pa.array([m for m, _ in deciders.names], type=pa.string()).take(pa.array(np.tile(np.arange(n), part.num_rows))),
                         pa.array(decided, mask=empty), pa.array((decided > TIE).astype(np.int32), mask=empty)],
                        names=layout.names,
                    )

    named = lambda c: "truth" if c == "y" else c
    layout = T.StructType([
        *[T.StructField(named(c), rows.schema[c].dataType) for c in (*on, *others)], T.StructField("model", T.StringType()),
        T.StructField("decision", T.DoubleType()), T.StructField("prediction", T.IntegerType()),
    ])
    return rows.mapInArrow(decide, layout)


def _dense(features: pa.Array) -> np.ndarray:
    """Sparse vectors as rows."""
    slots, values = (features.flatten().field(n).to_numpy(zero_copy_only=False) for n in ("bucket", "x"))
    sizes = np.nan_to_num(features.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    x = np.zeros((len(features), N_BUCKETS))
    x[np.repeat(np.arange(len(features)), sizes), slots] = values
    return x

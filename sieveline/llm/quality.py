"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Every text is described by a few statistics of its bytes, words and lines.  Random
cosines of the standardised statistics approximate a Gaussian kernel (Rahimi and
Recht 2007); ridge weights come from normal equations that each partition sums up
for its own rows; the scores are calibrated by isotonic regression on rows that the
ridge did not see.

Defined results.  A null text counts as empty and gets a score like any other.
Labels that are null, or whose document is absent, are not used; repeated labels
count each time.  A null ``doc_id`` is never labelled and never held out.  With no
usable label every score is 0.5.  Repeated rows get equal scores.  Columns other
than ``doc_id`` and ``text`` are not looked at and may have any name.  An empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from ..session import materialize
from .words import raw_texts

#: Cosine features, their seed, kernel width in standard deviations, and ridge penalty.
COSINES, SEED, WIDTH, PENALTY = 192, 11, 4.0, 1e-3
#: Labelled rows the model is fitted on, about: the bound of the sample.
FIT_ROWS = 60_000
#: Tasks that sum normal equations, and the steps of a score that calibration tells apart.
SUMS, STEPS = 16, 4096
#: Contract: a document is kept if its score is at least this.
THRESHOLD = 0.3

_CLASSES = np.zeros(256, dtype=np.uint8)
for _number, _bytes in enumerate([
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c",
    b".,;:", b"!?", b"|", b"#$%&*", b"'\"()-", bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0)),
], 1):
    _CLASSES[list(_bytes)] = _number
N_CLASSES = 14
N_STATISTICS = N_CLASSES + 8


def statistics_of(raw: bytes) -> list[float]:
    """Shares of byte classes, and repetition and length of words and lines."""
    size = max(1, len(raw))
    shares = np.zeros(N_CLASSES)
    for at in range(0, len(raw), 1 << 20):
        part = np.frombuffer(raw[at:at + (1 << 20)], dtype=np.uint8)
        shares += np.bincount(_CLASSES[part], minlength=N_CLASSES)
    words = raw.lower().split()
    lines = raw.split(b"\n")
    n = max(1, len(words))
    counts = Counter(words)
    return [
        *(shares / size).tolist(),
        np.log1p(len(raw)), np.log1p(len(words)), min(50.0, len(raw) / n),
        len(counts) / n, max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, stats``, one row per document row."""
    def compute(batches):
        for batch in batches:
            stats = [statistics_of(raw) for raw in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(stats, type=pa.list_(pa.float64()))], ["doc_id", "stats"]
            )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(compute, rows.select("doc_id").schema.add("stats", ArrayType(DoubleType())))


def fold(doc_id: Column) -> Column:
    """0 to 4; fold 0 is held out, fold 1 calibrates, the others fit."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(4))


@dataclass(frozen=True)
class Model:
    """Standardisation, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return _cosines(stats, self.mean, self.scale) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return np.full(len(stats), 0.5)
        return np.interp(self.ridge(stats), self.raw, self.calibrated)


def _cosines(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random cosines of the standardised statistics, and a constant."""
    rng = np.random.RandomState(SEED)
    directions = rng.standard_normal((N_STATISTICS, COSINES)) / WIDTH
    shifts = rng.uniform(0, 2 * np.pi, COSINES)
    z = np.clip((stats.reshape(-1, N_STATISTICS) - mean) / scale, -8, 8)
    return np.hstack([np.cos(z @ directions + shifts) * np.sqrt(2 / COSINES), np.ones((len(z), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


def _normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``X'X`` and ``X'y``: each of SUMS tasks adds up its own rows in a fixed
    order, and as many matrices of fixed size are added on the driver."""
    width = COSINES + 1

    def add(batches):
        gram, target, part = np.zeros((width, width)), np.zeros(width), None
        for batch in batches:
            part = batch.column(0)[0].as_py() if batch.num_rows else part
            x = _cosines(_matrix(batch.column(2)), mean, scale)
            gram += x.T @ x
            target += x.T @ batch.column(3).to_numpy(zero_copy_only=False).astype(float)
        if part is not None:
            yield pa.RecordBatch.from_pydict({"part": [part], "sums": [np.concatenate([gram.ravel(), target])]})

    parts = (
        rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(SUMS)).alias("part"), "doc_id", "stats", "y")
        .repartition(SUMS, "part").sortWithinPartitions("part", "doc_id", "y")
    )
    sums = np.zeros(width * width + width)
    for row in sorted(parts.mapInArrow(add, "part long, sums array<double>").collect()):
        sums += np.array(row.sums)
    return sums[:width * width].reshape(width, width), sums[width * width:]


def isotonic(x, n, y) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising mean of ``y / n`` over ascending ``x``.
    Returns the mean place and value of each pool."""
    pools: list[list[float]] = []
    for place, count, total in zip(x, n, y):
        pools.append([place * count, count, total])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model of ``labels.quality`` from ``stats`` (see :func:`statistics`).

    Of more than ``fit_rows`` labelled rows outside fold 0, about that many are
    used, chosen by a hash of their ids.
    """
    known = labels.select("doc_id", F.col("quality").cast("double").alias("y")).filter("y IS NOT NULL")
    rows = stats.join(known, "doc_id").withColumn("fold", fold(F.col("doc_id"))).filter("fold != 0")
    rows = materialize(rows, "labelled")
    share = min(1.0, fit_rows / max(1, rows.count()))
    rows = rows.filter(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    moments = rows.agg(*[
        f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(N_STATISTICS)
        for name, f in (("mean", F.avg), ("scale", F.stddev_pop))
    ]).first()
    if moments[0] is None:
        return Model(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0))
    mean = np.round([moments[f"mean{i}"] for i in range(N_STATISTICS)], 9)
    scale = np.round([moments[f"scale{i}"] for i in range(N_STATISTICS)], 9)
    scale = np.where(scale > 1e-6, scale, 1.0)
    learn, check = rows.filter("fold > 1"), rows.filter("fold = 1")
    if learn.isEmpty() or check.isEmpty():  # too few labels to keep two folds apart
        learn = check = rows
    gram, target = _normal_equations(learn, mean, scale)
    n_rows = gram[-1, -1]
    weights = np.linalg.solve(gram + PENALTY * n_rows * np.diag([*[1.0] * COSINES, 1e-9]), target)
    ridge = Model(mean, scale, weights, np.zeros(0), np.zeros(0)).ridge

    def place(batches):
        for batch in batches:
            values = np.clip(ridge(_matrix(batch.column(0))), -0.5, 1.5)
            step = np.floor((values + 0.5) / 2 * (STEPS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(1)], ["step", "y"])

    steps = (
        check.select("stats", "y").mapInArrow(place, "step long, y double")
        .groupBy("step").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("step").collect()
    )
    middle = [(s.step + 0.5) / (STEPS - 1) * 2 - 0.5 for s in steps]
    return Model(mean, scale, weights, *isotonic(middle, [s.n for s in steps], [s.y for s in steps]))


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``stats``."""
    def compute(batches):
        for batch in batches:
            scores = model.scores(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    scored = stats.mapInArrow(compute, stats.select("doc_id").schema.add("score", "double"))
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Scores of all documents by a model fitted on those that are labelled."""
    stats = materialize(statistics(docs), "statistics")
    return score(stats, fit(stats, labels, fit_rows))


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that score at least THRESHOLD, with all their columns.

    Statistics are taken again in the filtering pass: that is cheaper than moving
    the texts to their scores.
    """
    model = fit(statistics(docs), labels, fit_rows)
    schema: StructType = docs.schema
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            stats = np.array([statistics_of(raw) for raw in raw_texts(batch.column(at))])
            yield batch.filter(pa.array(model.scores(stats) >= THRESHOLD)) if batch.num_rows else batch

    return docs.mapInArrow(keep, schema)

"""Model parameters as table rows, and scoring against them.

A model is one row ``(model, .., params array<double>)`` of a few thousand
numbers.  All learners but the multi-layer perceptron decide by the sign of
``bias + weights . x``, so they share one scoring expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import total
from ..functions.hashing import N_BUCKETS
from ..functions.vectors import dot, squared_norm

# Names under which the models are logged.
NAIVE_BAYES = "Multinomial Naive Bayes"
LOGISTIC = "SGD Classifier"
PERCEPTRON = "Perceptron"
MLP = "Multi Layer Perceptron"
CLUSTERING = "Clustering"
CLASSIFIERS = (NAIVE_BAYES, LOGISTIC, PERCEPTRON, MLP)
ALL_MODELS = (*CLASSIFIERS, CLUSTERING)

HIDDEN_UNITS = 15

#: Decision values this close to zero are ties and go to class or cluster 0, so
#: that the order in which numbers were added up decides nothing.
TIE = 1e-9

#: Bytes of models that a task of :func:`score_checkpoints` holds.
BROADCAST_LIMIT = 16 << 20


def slice_of(params: Column, start: int, length: int) -> Column:
    return F.slice(params, start + 1, length)


def log_likelihoods(sums: Column) -> Column:
    """Smoothed log probabilities of the buckets of one class."""
    log_total = F.log(total(F.transform(sums, lambda s: s + 1.0)))
    return F.zip_with(sums, F.array_repeat(log_total, F.size(sums)), lambda s, t: F.log(s + 1.0) - t)


@lru_cache(maxsize=4)
def _scorer_columns(n_buckets: int, context: SparkContext) -> dict[str, Column]:
    """Turn ``params`` into ``bias``, ``weights`` and, for the perceptron with a
    hidden layer, ``hidden`` (one ``bias, weights`` per unit).

    Layouts of ``params``: Naive Bayes and clustering hold two class or cluster
    sizes and then two vectors; the linear models hold the intercept and the
    weights; the network holds, per hidden unit, its intercept and weights, and
    then the output intercept and weights.
    """
    p, name = F.col("params"), F.col("model")
    first, second = slice_of(p, 2, n_buckets), slice_of(p, 2 + n_buckets, n_buckets)
    n0, n1 = F.get(p, F.lit(0)), F.get(p, F.lit(1))
    # A class that has no rows yet is never predicted.
    prior = (
        F.when(n1 == 0, F.lit(float("-inf"))).when(n0 == 0, F.lit(float("inf"))).otherwise(F.log(n1) - F.log(n0))
    )
    unit = 1 + n_buckets
    output_at = HIDDEN_UNITS * unit
    bias = (
        F.when(name == NAIVE_BAYES, prior)
        .when(name == CLUSTERING, squared_norm(first) - squared_norm(second))
        .when(name == MLP, F.get(p, F.lit(output_at)))
        .otherwise(n0)
    )
    weights = (
        F.when(name == NAIVE_BAYES, F.zip_with(log_likelihoods(second), log_likelihoods(first), lambda a, b: a - b))
        .when(name == CLUSTERING, F.zip_with(second, first, lambda a, b: (a - b) * 2.0))
        .when(name == MLP, slice_of(p, output_at + 1, HIDDEN_UNITS))
        .otherwise(slice_of(p, 1, n_buckets))
    )
    hidden = F.when(name == MLP, F.transform(
        F.sequence(F.lit(0), F.lit(HIDDEN_UNITS - 1)),
        lambda k: F.struct(
            F.get(p, k * unit).alias("bias"), F.slice(p, k * unit + 2, F.lit(n_buckets)).alias("weights")
        ),
    ))
    return {"bias": bias, "weights": weights, "hidden": hidden}


def as_scorer(models: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """Models ready to be joined with rows: ``params`` made ``bias, weights, hidden``."""
    return models.withColumns(_scorer_columns(n_buckets, models.sparkSession.sparkContext)).drop("params")


@lru_cache(maxsize=4)
def _decision(context: SparkContext) -> Column:
    """Decision value of a row joined with a scorer; positive means class 1."""
    features = F.col("features")
    linear = dot(features, F.col("weights"))
    activations = F.transform("hidden", lambda h: F.tanh(h.bias + dot(features, h.weights)))
    network = total(F.zip_with(activations, "weights", lambda a, w: a * w))
    return F.col("bias") + F.when(F.col("hidden").isNull(), linear).otherwise(network)


def score(rows: DataFrame, models: DataFrame, on: Sequence[str], broadcast: bool = True) -> DataFrame:
    """Every row scored by every model that shares its ``on`` columns.

    Adds ``model``, ``decision`` and ``prediction`` and renames ``y`` to
    ``truth``.  ``broadcast`` is for a model table of proven size, such as the
    models of a list of checkpoints, which go to the tasks as matrices; without it the
    sides meet by a shuffle.
    """
    if broadcast:
        from .curves import decisions_by_key

        return decisions_by_key(rows, models, on)
    joined = rows.join(as_scorer(models), list(on))
    return (
        joined.withColumn("decision", _decision(rows.sparkSession.sparkContext))
        .withColumn("prediction", (F.col("decision") > TIE).cast("int"))
        .withColumnRenamed("y", "truth")
        .drop("features", "bias", "weights", "hidden")
    )


def tested_checkpoints(last: int, every: int = 10) -> list[int]:
    """Every tenth checkpoint and the last one: testing them all would take time that
    grows with the square of the data."""
    return sorted({*range(every, last + 1, every), last})


def score_checkpoints(rows: DataFrame, models: DataFrame, checkpoints: Sequence[int]) -> DataFrame:
    """Rows scored by each listed checkpoint of each model, ``checkpoint`` added, as
    :func:`score` does it, by products of blocks.

    A task holds models within a limit, so a long list costs more tasks and no larger ones.
    """
    from .curves import every_decision

    if not checkpoints:
        raise ValueError("no checkpoint to score")
    chosen = models.filter(F.col("batch_no").isin(list(checkpoints))).select("model", F.col("batch_no").alias("checkpoint"), "params")
    keep = [c for c in rows.columns if c not in ("y", "features")]
    scored = every_decision(rows, chosen, keep, values=True, block_bytes=BROADCAST_LIMIT)
    return scored.select("checkpoint", *[F.col("truth") if c == "y" else F.col(c) for c in rows.columns if c != "features"],
                         "model", "decision", "prediction")

"""Multinomial Naive Bayes: sums per class and bucket, exact in any order."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import N_BUCKETS
from .batching import prefix_sum
from .models import NAIVE_BAYES, log_likelihoods, slice_of


def _contributions(rows: DataFrame) -> DataFrame:
    """One ``(slot, x)`` per vector entry, plus one that counts the row itself.

    Slots follow the model layout: class sizes at 0 and 1, then the 512 sums of
    class 0 and the 512 sums of class 1.
    """
    entries = F.transform(
        "features",
        lambda e: F.struct((2 + F.col("y") * N_BUCKETS + e.bucket).alias("slot"), e.x.alias("x")),
    )
    itself = F.array(F.struct(F.col("y").alias("slot"), F.lit(1.0).alias("x")))
    return rows.select("batch_no", F.inline(F.concat(itself, entries)))


def class_sums(rows: DataFrame) -> DataFrame:
    """``batch_no, slot, s``: at most 1,026 rows per batch leave the map side."""
    return _contributions(rows).groupBy("batch_no", "slot").agg(F.sum("x").alias("s"))


def batch_updates(rows: DataFrame) -> dict[int, np.ndarray]:
    """What each batch in ``rows`` adds to the model, as a vector of 1,026 sums.

    For the few batches of one micro-batch; the first two sums count their rows.
    """
    sums = class_sums(rows).toArrow()
    numbers, slots, s = (sums[c].to_numpy() for c in ("batch_no", "slot", "s"))
    order, place = np.unique(numbers, return_inverse=True)
    added = np.zeros((len(order), 2 + 2 * N_BUCKETS))
    added[place, slots] = s
    return dict(zip(order.tolist(), added))


def cumulative_models(rows: DataFrame, n_batches: int | None = None) -> DataFrame:
    """The model after every batch, ``batch_no, model, params``, in one pass.

    Sums are made dense per batch and run up over the batches, slot by slot.
    ``n_batches``, if known, lets a short run use a single window.
    """
    per_batch = class_sums(rows).groupBy("batch_no").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "s"))).alias("sums")
    )
    dense = per_batch.select(
        "batch_no",
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(1 + 2 * N_BUCKETS)),
            lambda i: F.coalesce(F.try_element_at("sums", i), F.lit(0.0)),
        )).alias("slot", "s"),
    )
    running = prefix_sum(dense, "batch_no", {"s": "upto"}, keys=["slot"], span=n_batches)
    return running.groupBy("batch_no").agg(
        F.sort_array(F.collect_list(F.struct("slot", "upto"))).alias("slots")
    ).select("batch_no", F.lit(NAIVE_BAYES).alias("model"), F.col("slots.upto").alias("params"))


def model_table(models: DataFrame) -> DataFrame:
    """``batch_no, y, bucket, log_prior, log_likelihood`` of each model."""
    p = F.col("params")
    n = [F.get(p, F.lit(c)) for c in (0, 1)]
    classes = [
        F.struct(
            F.lit(c).alias("y"),
            F.when(n[c] > 0, F.log(n[c]) - F.log(n[0] + n[1])).alias("log_prior"),
            log_likelihoods(slice_of(p, 2 + c * N_BUCKETS, N_BUCKETS)).alias("logs"),
        )
        for c in (0, 1)
    ]
    return models.select("batch_no", F.inline(F.array(*classes))).select(
        "batch_no", "y", "log_prior", F.posexplode("logs").alias("bucket", "log_likelihood")
    )

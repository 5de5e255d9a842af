"""Two-centre k-means whose centres are running means over all rows seen."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import N_BUCKETS
from ..functions.vectors import dot
from .models import CLUSTERING, score
from .naive_bayes import batch_updates
from .sharded import moved_centres


def model_row(rows: DataFrame, params: np.ndarray, batch_no: int) -> DataFrame:
    """Model parameters held by the driver (1,026 numbers) as a one-row table."""
    return rows.sparkSession.createDataFrame(
        pa.table({"batch_no": [batch_no], "model": [CLUSTERING], "params": [params]})
    )


def _dense(entries) -> np.ndarray:
    vector = np.zeros(N_BUCKETS)
    for e in entries:
        vector[e["bucket"]] = e["x"]
    return vector


def initial_model(first_batch: DataFrame) -> np.ndarray:
    """Centre 0 is the first row of the batch, centre 1 the row farthest from it
    (the earliest of equals).  Distances are compared to nine decimals."""
    spark = first_batch.sparkSession
    start = _dense(first_batch.agg(F.min_by("features", "row_in_batch")).first()[0])
    centre = spark.createDataFrame(pa.table({"batch_no": [1], "weights": [start]}))
    distance = F.round(
        F.aggregate("features", F.lit(0.0), lambda acc, e: acc + e.x * e.x)
        - 2 * dot(F.col("features"), F.col("weights")), 9,
    )
    farthest = (
        first_batch.withColumn("batch_no", F.lit(1).cast("long"))
        .join(F.broadcast(centre), "batch_no")
        .agg(F.max_by("features", F.struct(distance, -F.col("row_in_batch"))))
        .first()[0]
    )
    return np.concatenate([np.zeros(2), start, _dense(farthest)])


def chance(seed: int, turn: int) -> Column:
    """A number in (0, 1] for every row of a batch, from a hash of the seed, the turn and its place."""
    name = F.concat_ws(":", F.lit(seed), F.lit(turn), F.col("row_in_batch"))
    return (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") + 1) / float(1 << 32)


def seeded_centres(first_batch: DataFrame, k: int = 2, seed: int = 0) -> list[np.ndarray]:
    """Centres drawn from the rows by squared distance (k-means++, Arthur and Vassilvitskii 2007).

    The first is any row; each further one is a row with a probability in proportion to
    its squared distance from the nearest centre so far.  Drawing with weights d is taking
    the least of ``-ln(u) / d``, one small aggregate a centre, and the same rows are drawn
    however they are partitioned.  With fewer different rows than centres the last
    one drawn is repeated.
    """
    rows = first_batch.withColumn("batch_no", F.lit(1).cast("long"))
    drawn = [_dense(rows.agg(F.min_by("features", F.struct(chance(seed, 0), "row_in_batch"))).first()[0])]
    square = F.aggregate("features", F.lit(0.0), lambda acc, e: acc + e.x * e.x)
    while len(drawn) < k:
        names = [f"centre{i}" for i in range(len(drawn))]
        table = rows.sparkSession.createDataFrame(pa.table({"batch_no": [1], **{n: [c] for n, c in zip(names, drawn)}}))
        gaps = [square - 2 * dot(F.col("features"), F.col(n)) + float(c @ c) for n, c in zip(names, drawn)]
        nearest = F.round(F.least(*gaps) if len(gaps) > 1 else gaps[0], 9)
        key = F.when(nearest > 0, F.struct(-F.log(chance(seed, len(drawn))) / nearest, "row_in_batch"))
        found = rows.join(F.broadcast(table), "batch_no").agg(F.min_by("features", key)).first()[0]
        drawn.append(_dense(found) if found is not None else drawn[-1])
    return drawn


def seeded_model(first_batch: DataFrame, seed: int) -> np.ndarray:
    """A start like :func:`initial_model`, with both centres drawn."""
    return np.concatenate([np.zeros(2), *seeded_centres(first_batch, 2, seed)])


def assign(rows: DataFrame, params: np.ndarray, batch_no: int) -> DataFrame:
    """Nearest centre of each row as ``prediction``; a tie goes to centre 0."""
    at = rows.withColumn("batch_no", F.lit(batch_no).cast("long")).withColumn("x", F.col("features"))
    return score(at, model_row(rows, params, batch_no), ["batch_no"]).withColumnRenamed("x", "features")


def update(rows: DataFrame, params: np.ndarray, batch_no: int) -> np.ndarray:
    """Move each centre to the mean of all rows it has been given so far.

    Rows are summed per cluster and bucket on the executors; 1,026 sums return.
    """
    assigned = assign(rows, params, batch_no).withColumn("y", F.col("prediction"))
    added = batch_updates(assigned.select("batch_no", "y", "features"))[batch_no]
    return moved_centres(params, added)

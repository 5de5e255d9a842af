"""A Naive Bayes training stream whose sums live in Spark's state store.

The sums are cut into blocks of slots, a key each.  Tasks add up their rows by batch and
slot; the state of a block takes the batches in order and gives its sums after each.
The driver holds neither sums nor models: those of a micro-batch are joined with its
rows, scored and written by the executors.  Spark's checkpoint brings the state back
when a query is started again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.hashing import N_BUCKETS
from ..operators.features import FeatureOptions, featurize
from ..operators.metrics import accuracy_precision_recall, confusion_counts
from ..operators.models import NAIVE_BAYES, score
from ..sources.replay import Replay, payload_rows, payload_stream
from .store import Store
from .train import BATCHES_PER_TRIGGER, start

SLOTS = 2 + 2 * N_BUCKETS
#: Slots of a key of the state.
BLOCK = 114
_BLOCKS = -(-SLOTS // BLOCK)


def block_sums(rows: DataFrame) -> DataFrame:
    """``block, batch_no, sums``: what the rows of a piece add to every block, blocks without
    rows included, so that each block sees every batch."""
    def add(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order, place = np.unique(batch.column("batch_no").to_numpy(), return_inverse=True)
            y = batch.column("y").to_numpy()
            total = np.zeros((len(order), _BLOCKS * BLOCK))
            np.add.at(total, (place, y), 1.0)
            buckets, xs = batch.column("buckets"), batch.column("xs")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(buckets.offsets.to_numpy()))
            np.add.at(total, (place[owner], 2 + y[owner] * N_BUCKETS + buckets.flatten().to_numpy()), xs.flatten().to_numpy())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.arange(_BLOCKS, dtype=np.int32), len(order))), pa.array(np.repeat(order, _BLOCKS)),
                pa.array(list(total.reshape(-1, BLOCK)), type=pa.list_(pa.float64())),
            ], names=["block", "batch_no", "sums"])

    entries = rows.select("batch_no", "y", F.col("features.bucket").alias("buckets"), F.col("features.x").alias("xs"))
    return entries.mapInArrow(add, "block int, batch_no long, sums array<double>")


def _after_each(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The sums of a block after each batch of a micro-batch."""
    total = np.array(state.get[0]) if state.exists else np.zeros(BLOCK)
    added: dict[int, np.ndarray] = {}
    for frame in frames:
        for batch_no, sums in zip(frame["batch_no"], frame["sums"]):
            added[batch_no] = added.get(batch_no, 0) + np.array(sums)
    made = []
    for batch_no in sorted(added):
        total = total + added[batch_no]
        made.append((key[0], batch_no, total))
    state.update((total.tolist(),))
    yield pd.DataFrame(made, columns=["block", "batch_no", "sums"])


def running_blocks(rows: DataFrame) -> DataFrame:
    """``block, batch_no, sums`` after every batch of a stream of feature rows."""
    return block_sums(rows).groupBy("block").applyInPandasWithState(
        _after_each, "block int, batch_no long, sums array<double>", "sums array<double>", "update",
        GroupStateTimeout.NoTimeout,
    )


def models_of(blocks: DataFrame) -> DataFrame:
    """``batch_no, model, params`` from the blocks of each batch."""
    parts = F.sort_array(F.collect_list(F.struct("block", "sums")))  # nine blocks
    return blocks.groupBy("batch_no").agg(parts.alias("parts")).select(
        "batch_no", F.lit(NAIVE_BAYES).alias("model"), F.slice(F.flatten("parts.sums"), 1, SLOTS).alias("params")
    )


def stream_bayes(
    spark: SparkSession, payload_dir: str, root: str, delay: int | None = None, batches_per_trigger: int = BATCHES_PER_TRIGGER,
    options: FeatureOptions = FeatureOptions(),
) -> StreamingQuery | Replay:
    """Train Naive Bayes alone on a log of payloads, into the tables of a store.

    As :func:`.train.stream_train`, but the log of payloads is read twice: for the sums,
    and for the rows that a micro-batch's models are scored on.
    """
    store = Store(spark, root)

    def log(blocks: DataFrame, epoch_id: int) -> None:
        made = models_of(blocks).persist()
        try:
            first, last = made.agg(F.min("batch_no"), F.max("batch_no")).first()
            if first is None:
                return
            rows = featurize(payload_rows(spark, payload_dir, first, last), options)
            scored = score(rows.select("batch_no", "y", "features"), made, ["batch_no"], broadcast=False)
            store.write_train_log(accuracy_precision_recall(confusion_counts(scored, ["model", "batch_no"])), epoch_id)
            store.write_whole_models(made, epoch_id)
            store.commit(
                epoch_id, first_batch=first, batch_no=last, sent_before=first - 1 or None, sent=last, shards=1, turn=0
            )
        finally:
            made.unpersist()

    progress = f"{store.path}/bayes_progress"
    rows = featurize(payload_stream(spark, payload_dir, batches_per_trigger, progress), options)
    return start(running_blocks(rows), log, progress, delay, mode="update")

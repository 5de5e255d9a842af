"""Inputs the registered queries share: batched features and finished runs.

They are derived from the whole tables, written once per session to the shared
folder and read by several queries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batching import batch_table
from ..operators.curves import checkpoint_counts, checkpoint_decisions
from ..operators.features import featurize
from ..operators.models import score_checkpoints, tested_checkpoints
from ..operators.naive_bayes import cumulative_models
from ..operators.payloads import encode_columnar
from ..session import materialize, work_dir
from ..sources.replay import write_payloads
from ..sources.tables import dataset_split, labelled_messages
from ..streaming.scoring import stream_test
from ..streaming.store import CLASSIFIER_FAMILY, CLUSTER_FAMILY, FINAL, Store
from ..streaming.train import stream_train

BATCH = 100

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, name: str, sf_dir: str, batch: int, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, name, sf_dir, batch)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def messages(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    """The labelled messages of the ``train`` or the ``test`` file, or of ``both``."""
    rows = labelled_messages(spark, sf_dir)
    return rows if part == "both" else dataset_split(rows, part)


def batched_messages(spark: SparkSession, sf_dir: str, batch: int = BATCH, part: str = "both") -> DataFrame:
    """Labelled messages in batches, text and all."""
    return batch_table(messages(spark, sf_dir, part), "row_id", batch)


def batched_features(spark: SparkSession, sf_dir: str, batch: int = BATCH, part: str = "train") -> DataFrame:
    """``row_id, y, features, row_no, batch_no, row_in_batch`` of the labelled messages.

    Features are computed where the text is read; only vectors are shuffled into
    batch order.
    """
    def build() -> DataFrame:
        return materialize(batch_table(featurize(messages(spark, sf_dir, part)), "row_id", batch), "features")

    return _once(spark, f"features-{part}", sf_dir, batch, build)


def naive_bayes_models(spark: SparkSession, sf_dir: str, batch: int = BATCH) -> DataFrame:
    """The Naive Bayes model after every batch."""
    rows = batched_features(spark, sf_dir, batch)
    n_batches = rows.agg(F.max("batch_no")).first()[0]
    return cumulative_models(rows, n_batches)


def payload_folder(spark: SparkSession, sf_dir: str, batch: int = BATCH, part: str = "train") -> str:
    """The labelled messages as a folder of payload files."""
    def build() -> str:
        path = work_dir(spark, "payloads")
        write_payloads(encode_columnar(batched_messages(spark, sf_dir, batch, part)), path)
        return path

    return _once(spark, f"payloads-{part}", sf_dir, batch, build)


def trained(spark: SparkSession, sf_dir: str, family: str = CLASSIFIER_FAMILY, batch: int = BATCH) -> Store:
    """The store of a finished training stream over the payload folder."""
    def build() -> Store:
        store = Store(spark, work_dir(spark, "run"), family)
        store.create()
        stream_train(
            spark, payload_folder(spark, sf_dir, batch), store.root, clustering=family == CLUSTER_FAMILY
        ).awaitTermination()
        return store

    return _once(spark, f"trained-{family}", sf_dir, batch, build)


def tested(spark: SparkSession, sf_dir: str, family: str = CLASSIFIER_FAMILY, batch: int = BATCH) -> Store:
    """The same store after a test stream of held-out messages with the final models."""
    def build() -> Store:
        store = trained(spark, sf_dir, family, batch)
        stream_test(
            spark, payload_folder(spark, sf_dir, batch, "test"), store.root,
            clustering=family == CLUSTER_FAMILY, model_num=FINAL,
        ).awaitTermination()
        return store

    return _once(spark, f"tested-{family}", sf_dir, batch, build)


def checkpoint_predictions(
    spark: SparkSession, sf_dir: str, family: str, batch: int = BATCH, checkpoints: Sequence[int] | None = None,
    model: str | None = None,
) -> DataFrame:
    """Every held-out row scored by some checkpoints of a family or of one ``model`` of it, every
    tenth and the last unless they are listed: the logs of a test run per checkpoint, in one table."""
    store = trained(spark, sf_dir, family, batch)
    rows = batched_features(spark, sf_dir, batch, "test").select("row_id", "batch_no", "y", "features")
    last = store.last_batch()
    return score_checkpoints(rows, store.models(model), checkpoints or tested_checkpoints(last))


def every_checkpoint(spark: SparkSession, sf_dir: str, family: str, model: str, batch: int = BATCH) -> DataFrame:
    """``row_id, batch_no, model, checkpoint, truth, prediction`` of every held-out row under every
    checkpoint of one model."""
    rows = batched_features(spark, sf_dir, batch, "test").select("row_id", "batch_no", "y", "features")
    models = trained(spark, sf_dir, family, batch).models(model)
    return checkpoint_decisions(
        rows, models.select("model", F.col("batch_no").alias("checkpoint"), "params"), ["row_id", "batch_no"]
    )


def tested_counts(spark: SparkSession, sf_dir: str, family: str, batch: int = BATCH) -> DataFrame:
    """Confusion counts of all held-out rows under every checkpoint of a family."""
    def build() -> DataFrame:
        store = trained(spark, sf_dir, family, batch)
        rows = batched_features(spark, sf_dir, batch, "test").select("row_id", "y", "features")
        models = store.models().select("model", F.col("batch_no").alias("checkpoint"), "params")
        counts = checkpoint_counts(rows, models)
        return materialize(counts.withColumn("is_final", F.col("checkpoint") == store.last_batch()), "tested-counts")

    return _once(spark, f"tested-counts-{family}", sf_dir, batch, build)

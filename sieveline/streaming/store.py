"""Model checkpoints and logs as partitioned tables.

Classifiers and clustering train in runs of their own, so each family has its
folder with ``models``, ``optimiser``, ``train_log``, ``test_log`` and ``commits``.  Every
micro-batch writes its own partitions and overwrites them when it is replayed, so one delivered
twice leaves one set of rows, while batches of another delivery are added.  A commit
is the last thing written: models and log rows without one do not count.

Models are chains: every ``SNAPSHOT_EVERY`` batches a model is written whole, and between
these only the parameters that a batch changed, with their new values, so that a
loaded model is exactly the one saved.  What an optimiser carries along is needed to
go on but not to score; it is kept for the last two micro-batches alone, the newest
and the one before, from which a newest one that comes again is learnt anew.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.models import CLASSIFIERS, CLUSTERING
from ..operators.sharded import ModelState

CLASSIFIER_FAMILY, CLUSTER_FAMILY = "classifiers", "clustering"
FAMILIES = {CLASSIFIER_FAMILY: CLASSIFIERS, CLUSTER_FAMILY: (CLUSTERING,)}

_COUNTS = "batch_no long, model string, n long, tp long, fp long, fn long, tn long"
TRAIN_LOG = {
    CLASSIFIER_FAMILY: f"{_COUNTS}, accuracy double, precision double, recall double",
    CLUSTER_FAMILY: (
        f"{_COUNTS}, accuracy_spam_1 double, precision_spam_1 double, recall_spam_1 double, "
        "accuracy_spam_0 double, precision_spam_0 double, recall_spam_0 double"
    ),
}
TEST_LOG = "batch_no long, row_in_batch int, model string, prediction int, truth int"
MODELS = "batch_no long, model string, slots array<int>, params array<double>, steps long"
OPTIMISER = "batch_no long, model string, moments array<double>, turn int"
COMMITS = "first_batch long, batch_no long, sent_before long, sent long, shards int, turn int"

#: Batches from one whole model to the next.
SNAPSHOT_EVERY = 16

#: Stands for "the model after the last batch", as in ``model_num=0``.
FINAL = 0


def model_rows(spark: SparkSession, by_batch: dict[int, dict[str, ModelState]]) -> DataFrame:
    """Models the driver holds as rows ``batch_no, model, params, steps``."""
    rows = [(n, m, s) for n, states in by_batch.items() for m, s in states.items()]
    return spark.createDataFrame(pa.table({
        "batch_no": pa.array([n for n, _, _ in rows], pa.int64()),
        "model": [m for _, m, _ in rows],
        "params": [s.params for _, _, s in rows],
        "steps": [s.steps for _, _, s in rows],
    }))


def chain_start(batch_no: int) -> int:
    """The batch whose whole model the chain of a batch begins with."""
    return (batch_no - 1) // SNAPSHOT_EVERY * SNAPSHOT_EVERY + 1


def chain_rows(by_batch: dict[int, dict[str, ModelState]], before: dict[str, ModelState]) -> pa.Table:
    """The models after consecutive batches as links of their chains: whole ones, or the
    slots that changed since the batch before and their new values."""
    rows = []
    for n in sorted(by_batch):
        earlier = by_batch.get(n - 1, before)
        for m, state in by_batch[n].items():
            slots = None
            if chain_start(n) != n:
                slots = np.flatnonzero(state.params != earlier[m].params).astype(np.int32)
            rows.append((n, m, slots, state.params if slots is None else state.params[slots], state.steps))
    columns = list(zip(*rows))
    kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["batch_no", "model", "slots", "params", "steps"])


def _replay(links: pd.DataFrame) -> pd.DataFrame:
    """The models of a chain, at most ``SNAPSHOT_EVERY``, from its links."""
    params, made = None, []
    for r in links.sort_values("batch_no").itertuples(index=False):
        if r.slots is None:
            params = np.array(r.params)
        else:
            params = params.copy()
            params[r.slots] = r.params
        made.append((r.batch_no, r.model, params, r.steps))
    return pd.DataFrame(made, columns=["batch_no", "model", "params", "steps"])


def replayed(links: DataFrame) -> DataFrame:
    """``batch_no, model, params, steps`` of every link of whole chains or their beginnings."""
    return links.groupBy("model", F.expr(f"(batch_no - 1) div {SNAPSHOT_EVERY}")).applyInPandas(
        _replay, "batch_no long, model string, params array<double>, steps long"
    )


class Store:
    """The tables of one family of models below ``root``."""

    def __init__(self, spark: SparkSession, root: str, family: str = CLASSIFIER_FAMILY):
        if family not in FAMILIES:
            raise ValueError(f"family must be one of {sorted(FAMILIES)}, not {family!r}")
        self.spark, self.family = spark, family
        self.root = root.rstrip("/")
        self.path = f"{self.root}/{family}"

    def _clear(self, table: str, schema: str) -> None:
        (self.spark.createDataFrame([], f"{schema}, epoch_id long")
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("epoch_id").parquet(f"{self.path}/{table}"))

    def _read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, epoch_id long").parquet(f"{self.path}/{table}")

    def _write(self, rows: DataFrame, table: str, epoch_id: int) -> None:
        """Replace the partition of one micro-batch and no other."""
        (rows.withColumn("epoch_id", F.lit(epoch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch_id").parquet(f"{self.path}/{table}"))

    def create(self) -> None:
        """Start from nothing: no models, empty logs."""
        self._clear("models", MODELS)
        self._clear("commits", COMMITS)
        (self.spark.createDataFrame([], OPTIMISER).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("turn").parquet(f"{self.path}/optimiser"))
        self.reset_logs()

    def reset_logs(self) -> None:
        """Empty every log and keep the models."""
        self._clear("train_log", TRAIN_LOG[self.family])
        (self.spark.createDataFrame([], f"{TEST_LOG}, checkpoint long, epoch_id long")
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("checkpoint", "epoch_id").parquet(f"{self.path}/test_log"))

    # Models

    def write_models(
        self, by_batch: dict[int, dict[str, ModelState]], before: dict[str, ModelState], epoch_id: int, turn: int
    ) -> None:
        """Save the models after each batch of a micro-batch, and the last ones' optimisers."""
        links = self.spark.createDataFrame(chain_rows(by_batch, before))
        self._write(links.coalesce(1), "models", epoch_id)
        last = max(by_batch)
        carried = [(last, m, s.moments.tolist(), turn % 2) for m, s in by_batch[last].items() if len(s.moments)]
        if carried:
            (self.spark.createDataFrame(carried, OPTIMISER).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("turn").parquet(f"{self.path}/optimiser"))

    def write_whole_models(self, models: DataFrame, epoch_id: int) -> None:
        """Save ``batch_no, model, params`` that the executors hold, each whole."""
        links = models.select("batch_no", "model", F.lit(None).cast("array<int>").alias("slots"), "params", F.lit(0).cast("long").alias("steps"))
        self._write(links, "models", epoch_id)

    def _links(self) -> DataFrame:
        return self._read("models", MODELS)

    def models(self, model: str | None = None) -> DataFrame:
        """``batch_no, model, params, steps`` after every batch, of one model or of all."""
        links = self._links()
        return replayed(links if model is None else links.filter(F.col("model") == model))

    def commit(self, epoch_id: int, **numbers: int | None) -> None:
        """Let the models and log rows of a micro-batch count."""
        names = [f.split()[0] for f in COMMITS.split(", ")]
        row = self.spark.createDataFrame([tuple(numbers[n] for n in names)], COMMITS)
        self._write(row, "commits", epoch_id)

    def last_commit(self) -> Row | None:
        """The newest commit; resetting the logs does not touch it."""
        return self._read("commits", COMMITS).orderBy(F.desc("epoch_id")).first()

    def last_batch(self) -> int:
        """Number of the last batch whose models are committed; 0 before the first."""
        last = self.last_commit()
        return last.batch_no if last else 0

    def load_models(self, model_num: int = FINAL) -> DataFrame:
        """Models saved after batch ``model_num``, or the final ones."""
        chosen = model_num if model_num != FINAL else self.last_batch()
        links = self._links().filter(F.col("batch_no").between(chain_start(chosen), chosen))
        return replayed(links).filter(F.col("batch_no") == chosen)

    def load_states(self, batch_no: int) -> dict[str, ModelState]:
        """One batch's models as arrays, a few thousand numbers each; ready to go on
        learning if they are the last of one of the two newest micro-batches."""
        carried = self.spark.read.schema(OPTIMISER).parquet(f"{self.path}/optimiser").filter(F.col("batch_no") == batch_no)
        moments = {r.model: np.array(r.moments) for r in carried.collect()}
        rows = self.load_models(batch_no).collect() if batch_no else []
        return {r.model: ModelState(np.array(r.params), moments.get(r.model, np.zeros(0)), r.steps) for r in rows}

    # Logs

    def write_train_log(self, rows: DataFrame, epoch_id: int) -> None:
        columns = [f.split()[0] for f in TRAIN_LOG[self.family].split(", ")]
        self._write(rows.select(*columns).coalesce(1), "train_log", epoch_id)

    def train_log(self) -> DataFrame:
        return self._read("train_log", TRAIN_LOG[self.family])

    def start_test(self, model_num: int) -> None:
        """Empty the log of one checkpoint, as a new test run does."""
        self._clear(f"test_log/checkpoint={model_num}", TEST_LOG)

    def tested_before(self, model_num: int, epoch_id: int) -> int:
        """How many batches of a test run were logged before a micro-batch."""
        log = self.test_log().filter((F.col("checkpoint") == model_num) & (F.col("epoch_id") < epoch_id))
        return log.agg(F.max("batch_no")).first()[0] or 0

    def write_test_log(self, scored: DataFrame, model_num: int, epoch_id: int) -> None:
        rows = scored.select("batch_no", "row_in_batch", "model", "prediction", "truth")
        self._write(rows, f"test_log/checkpoint={model_num}", epoch_id)

    def test_log(self) -> DataFrame:
        """``checkpoint, epoch_id, batch_no, row_in_batch, model, prediction, truth``."""
        return self.spark.read.schema(f"{TEST_LOG}, checkpoint long, epoch_id long").parquet(f"{self.path}/test_log")

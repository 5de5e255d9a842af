"""Incremental training over micro-batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import N_BUCKETS
from ..operators import kmeans
from ..operators.features import FeatureOptions, featurize
from ..operators.metrics import accuracy_precision_recall, confusion_counts, dual_polarity
from ..operators.models import CLUSTERING, NAIVE_BAYES, score
from ..operators.naive_bayes import batch_updates
from ..operators.sharded import SHARDS, ModelState, fit_batches, initial_state
from ..session import has_table
from ..sources.replay import Replay, number_plain, payload_stream
from .progress import observed
from .store import CLASSIFIER_FAMILY, CLUSTER_FAMILY, FAMILIES, Store, model_rows


#: Batches one micro-batch takes in.  A micro-batch costs some seconds whatever it holds.
#: The models of its batches are held, sent and written together, 78 kB for the four
#: classifiers of a batch: 20 MB, within what a broadcast may carry.
BATCHES_PER_TRIGGER = 256


class Trainer:
    """Carries the models of one family from batch to batch.

    Call it with the feature rows of each micro-batch and its number.  A
    micro-batch may hold several batches; they are learnt one after another and
    scored, saved and logged together.  Rows stay on the executors: what the
    driver holds are the models, at most 23,133 numbers each, and their sums.  With
    ``seed`` the clusterer draws its first centres, else it takes rows far apart.
    """

    def __init__(
        self,
        store: Store,
        shards: int = SHARDS,
        prequential: bool = False,
        models: tuple[str, ...] | None = None,
        seed: int | None = None,
    ):
        self.store, self.shards, self.prequential, self.seed = store, shards, prequential, seed
        self.models = models or FAMILIES[store.family]
        last = store.last_commit()
        if last and last.shards != shards:
            raise ValueError(f"the models were learnt in {last.shards} shards, not {shards}")
        self.last_epoch = last.epoch_id if last else -1
        self.turn = last.turn + 1 if last else 0
        self._resume_after(last.batch_no if last else 0, last.sent if last else None)

    def _resume_after(self, batch_no: int, sent: int | None) -> None:
        self.batch_no, self.sent = batch_no, sent
        self.states = self.store.load_states(batch_no) if batch_no else {}

    def __call__(self, rows: DataFrame, epoch_id: int) -> None:
        """Learn the batches of one micro-batch of ``batch_no, row_in_batch, y,
        features``, in the order of their numbers; skip an empty one.

        A number at or below the last one learnt means that batches come in another
        order than they were cut in, and is an error.  The commit is written last.
        A micro-batch that comes again, because the run broke before that, is learnt
        again from the models before it and overwrites what it left.
        """
        if epoch_id < self.last_epoch:
            return
        if epoch_id == self.last_epoch:
            done = self.store.last_commit()
            self.turn = done.turn
            self._resume_after(done.first_batch - 1, done.sent_before)
        features = rows.select("batch_no", "row_in_batch", "y", "features").persist()
        try:
            # The class sums hold the class sizes, so they find and count the batches too.
            sums = batch_updates(features)
            if not sums:
                return
            order = sorted(sums)
            if self.sent is not None and order[0] <= self.sent:
                raise ValueError(f"batch {order[0]} came after batch {self.sent}")
            start = self.states or self._fresh(features.filter(F.col("batch_no") == order[0]))
            after = self._fit(features, start, sums)
            numbers = {sent: self.batch_no + i + 1 for i, sent in enumerate(order)}
            self.store.write_models({numbers[sent]: after[sent] for sent in order}, start, epoch_id, self.turn)
            before = dict(zip(order, [start] + [after[sent] for sent in order[:-1]]))
            self._log(features, before if self.prequential else after, numbers, epoch_id)
            self.store.commit(
                epoch_id, first_batch=self.batch_no + 1, batch_no=numbers[order[-1]], sent_before=self.sent,
                sent=order[-1], shards=self.shards, turn=self.turn,
            )
        finally:
            features.unpersist()
        self.batch_no, self.states, self.last_epoch = numbers[order[-1]], after[order[-1]], epoch_id
        self.sent, self.turn = order[-1], self.turn + 1

    def _fresh(self, features: DataFrame) -> dict[str, ModelState]:
        start = {}
        for m in self.models:
            if m == CLUSTERING:
                start[m] = ModelState(
                    kmeans.initial_model(features) if self.seed is None else kmeans.seeded_model(features, self.seed)
                )
            elif m == NAIVE_BAYES:
                start[m] = ModelState(np.zeros(2 + 2 * N_BUCKETS))
            else:
                start[m] = initial_state(m)
        return start

    def _fit(
        self, features: DataFrame, start: dict[str, ModelState], sums: dict[int, np.ndarray]
    ) -> dict[int, dict[str, ModelState]]:
        """The models after each batch."""
        order = sorted(sums)
        after: dict[int, dict[str, ModelState]] = {sent: {} for sent in order}
        if NAIVE_BAYES in start:
            total = start[NAIVE_BAYES].params
            for sent in order:
                total = total + sums[sent]
                after[sent][NAIVE_BAYES] = ModelState(total)
        in_order = {m: s for m, s in start.items() if m != NAIVE_BAYES}
        if in_order:
            for sent, states in fit_batches(
                features, in_order, order, self.shards, {sent: int(sums[sent][:2].sum()) for sent in order}
            ).items():
                after[sent].update(states)
        return after

    def _log(
        self, features: DataFrame, judged: dict[int, dict[str, ModelState]], numbers: dict[int, int], epoch_id: int
    ) -> None:
        """Score every batch with its models and log the metrics under its number."""
        models = model_rows(self.store.spark, judged).select("batch_no", "model", "params")
        counts = confusion_counts(score(features, models, ["batch_no"]), ["model", "batch_no"])
        number = F.create_map(*[F.lit(n).cast("long") for pair in numbers.items() for n in pair])
        measured = dual_polarity(counts) if self.store.family == CLUSTER_FAMILY else accuracy_precision_recall(counts)
        self.store.write_train_log(
            measured.withColumn("batch_no", F.element_at(number, F.col("batch_no"))), epoch_id
        )


def stream_train(
    spark: SparkSession,
    payload_dir: str,
    root: str,
    clustering: bool = False,
    delay: int | None = None,
    batches_per_trigger: int = BATCHES_PER_TRIGGER,
    options: FeatureOptions = FeatureOptions(),
    plain: bool = False,
    observe: bool = False,
    **trainer_options,
) -> StreamingQuery | Replay:
    """Start training on a log of payloads, or with ``plain`` on a folder of payload
    lines without batch numbers, which become a log first.

    With ``delay`` a micro-batch starts every so many seconds until the query is
    stopped; ``observe`` counts the rows for :class:`.progress.Progress`.  Without ``delay`` one
    micro-batch follows another and awaiting the end means to wait until the
    log is used up.  A query started again on the same root goes on where the last one
    stopped.  Every batch is a training step of its own, however many one micro-batch
    takes in.
    """
    store = Store(spark, root, CLUSTER_FAMILY if clustering else CLASSIFIER_FAMILY)
    trainer = Trainer(store, **trainer_options)
    log = payload_dir
    if plain:
        log = f"{store.path}/plain_log"
        if not has_table(spark, f"{log}/index"):
            number_plain(spark, payload_dir, log)
    progress = f"{store.path}/train_progress"
    rows = featurize(payload_stream(spark, log, batches_per_trigger, progress), options)
    return start(observed(rows) if observe else rows, trainer, progress, delay)


def start(
    rows: DataFrame, learn_or_score, progress: str, delay: int | None, mode: str = "append"
) -> StreamingQuery | Replay:
    """Run a function on every micro-batch, at an interval or until a log is used up."""
    writer = rows.writeStream.outputMode(mode).foreachBatch(learn_or_score).option("checkpointLocation", progress)
    if delay:
        return writer.trigger(processingTime=f"{delay} seconds").start()
    return Replay(writer.start())

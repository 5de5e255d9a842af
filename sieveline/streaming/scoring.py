"""Scoring a stream with the models of one checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.features import FeatureOptions, featurize
from ..operators.models import score
from ..session import work_dir
from ..sources.replay import Replay, payload_stream
from .store import CLASSIFIER_FAMILY, CLUSTER_FAMILY, FINAL, Store, model_rows
from .train import BATCHES_PER_TRIGGER, start, stream_train


class Scorer:
    """Logs one prediction per model and row for each micro-batch of feature rows."""

    def __init__(self, store: Store, model_num: int = FINAL):
        self.store, self.model_num = store, model_num
        self.logged, self.next_epoch = 0, -1
        states = store.load_states(model_num if model_num != FINAL else store.last_batch())
        if not states:
            raise ValueError(f"no models saved under number {model_num}")
        # At most four models of 7,711 numbers: a fixed, small broadcast.
        self.table = model_rows(store.spark, {model_num: states}).select(
            F.col("batch_no").alias("checkpoint"), "model", "params"
        )

    def __call__(self, rows: DataFrame, epoch_id: int) -> None:
        """Log the batches of a micro-batch under numbers given on arrival, as in
        training.  An empty one writes nothing; one that comes again replaces its rows."""
        sent = sorted(r.batch_no for r in rows.select("batch_no").distinct().collect())  # a trigger's batches
        if not sent:
            return
        if epoch_id != self.next_epoch:  # the first one, or one that comes again
            self.logged = self.store.tested_before(self.model_num, epoch_id)
        first = self.logged + 1
        number = F.create_map(*[F.lit(n).cast("long") for i, b in enumerate(sent) for n in (b, first + i)])
        asked = rows.select(
            F.lit(self.model_num).cast("long").alias("checkpoint"),
            F.element_at(number, F.col("batch_no")).alias("batch_no"), "row_in_batch", "y", "features",
        )
        self.store.write_test_log(score(asked, self.table, ["checkpoint"]), self.model_num, epoch_id)
        self.logged, self.next_epoch = self.logged + len(sent), epoch_id + 1


def stream_test(
    spark: SparkSession,
    payload_dir: str,
    root: str,
    clustering: bool = False,
    model_num: int = FINAL,
    delay: int | None = None,
    batches_per_trigger: int = BATCHES_PER_TRIGGER,
    options: FeatureOptions = FeatureOptions(),
) -> StreamingQuery | Replay:
    """Empty the checkpoint's test log and start scoring a log of payloads."""
    store = Store(spark, root, CLUSTER_FAMILY if clustering else CLASSIFIER_FAMILY)
    scorer = Scorer(store, model_num)
    store.start_test(model_num)
    rows = featurize(payload_stream(spark, payload_dir, batches_per_trigger), options)
    return start(rows, scorer, work_dir(spark, "test_progress"), delay)


def run(spark: SparkSession, mode: str, payload_dir: str, root: str, **options) -> StreamingQuery | Replay:
    """Start a query by mode, ``train`` or ``test``."""
    modes = {"train": stream_train, "test": stream_test}
    if mode.lower() not in modes:
        raise ValueError(f"mode must be 'train' or 'test', not {mode!r}")
    return modes[mode.lower()](spark, payload_dir, root, **options)

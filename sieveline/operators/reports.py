"""Training and test curves as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import truncate3
from .metrics import accuracy_precision_recall, confusion_counts, invert_counts
from .models import CLASSIFIERS, CLUSTERING

METRICS = ("accuracy", "precision", "recall")

TEST_ACCURACY, MODEL_CURVES, METRIC_CURVES = 1, 2, 3


def metrics_to_long(log: DataFrame, keys: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per metric: the keys, ``metric`` and ``value``."""
    return log.unpivot(list(keys), list(metrics), "metric", "value")


def curve_of_model(train_log: DataFrame, model: str) -> DataFrame:
    """Training curves of one model by batch."""
    return metrics_to_long(train_log.filter(F.col("model") == model), ["batch_no"])


def curves_of_all_models(train_log: DataFrame, models: Sequence[str] = CLASSIFIERS) -> DataFrame:
    """Training curves of the supervised models on one batch axis: a column per
    model, null where a model has no row for a batch."""
    long = metrics_to_long(train_log.filter(F.col("model").isin(list(models))), ["model", "batch_no"])
    return long.groupBy("metric", "batch_no").pivot("model", list(models)).agg(F.first("value"))


def test_accuracy_bars(test_log: DataFrame) -> DataFrame:
    """Accuracy of each model and the label a bar would carry."""
    accuracy = F.avg((F.col("prediction") == F.col("truth")).cast("double"))
    return test_log.groupBy("model").agg(accuracy.alias("accuracy")).withColumn(
        "bar_label", truncate3(F.col("accuracy"))
    )


def test_curve(test_log: DataFrame, include_final: bool = False) -> DataFrame:
    """:func:`curve_of_counts` of a log of predictions, one row per record."""
    kept = [c for c in ("is_final",) if c in test_log.columns]
    return curve_of_counts(confusion_counts(test_log, ["model", "checkpoint", *kept]), include_final)


def curve_of_counts(counts: DataFrame, include_final: bool = False) -> DataFrame:
    """Test metrics by checkpoint, one row per model, polarity, checkpoint and metric,
    from the confusion counts of each model and checkpoint.

    Clusters have no fixed meaning, so the clusterer appears under both polarities.  The
    final model is left out unless asked for; ``is_final`` marks its rows where the
    counts have it.
    """
    if not include_final and "is_final" in counts.columns:
        counts = counts.filter(~F.col("is_final"))
    clusters = counts.filter(F.col("model") == CLUSTERING)
    both = counts.withColumn("polarity", F.lit(1)).unionByName(
        invert_counts(clusters).withColumn("polarity", F.lit(0))
    )
    return metrics_to_long(accuracy_precision_recall(both), ["model", "polarity", "checkpoint"])


def in_curve_order(curve: DataFrame) -> DataFrame:
    return curve.orderBy("metric", "model", "polarity", F.col("checkpoint").cast("int"))


def numbered_curve(curve: DataFrame) -> DataFrame:
    """The points of every curve numbered in order of their checkpoints."""
    line = Window.partitionBy("model", "polarity", "metric").orderBy(F.col("checkpoint").cast("int"))
    return curve.withColumn("place", F.row_number().over(line))


def preview(log: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """First rows of a log in a stated order."""
    return log.orderBy(*order).limit(n)


def report(mode: int, train_log: DataFrame | None = None, test_log: DataFrame | None = None) -> DataFrame:
    """1: test accuracy per model; 2: training curves per model; 3: training
    curves of all models per metric."""
    if mode == TEST_ACCURACY:
        return test_accuracy_bars(test_log.filter(F.col("model").isin(list(CLASSIFIERS))))
    if mode == MODEL_CURVES:
        return metrics_to_long(train_log, ["model", "batch_no"])
    if mode == METRIC_CURVES:
        return curves_of_all_models(train_log)
    raise ValueError(f"mode must be 1, 2 or 3, not {mode!r}")

"""Classification metrics from predictions and truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def confusion_counts(scored: DataFrame, keys: Sequence[str], truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    """``n, tp, fp, fn, tn`` per key, all four from one partially aggregated pass."""
    t, p = F.col(truth), F.col(prediction)
    return scored.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    )


def accuracy_precision_recall(counts: DataFrame) -> DataFrame:
    """Add the three metrics of class 1 to confusion counts."""
    return counts.withColumns({
        "accuracy": ratio(F.col("tp") + F.col("tn"), F.col("n")),
        "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
    })


def classification_metrics(scored: DataFrame, keys: Sequence[str], **columns: str) -> DataFrame:
    return accuracy_precision_recall(confusion_counts(scored, keys, **columns))


def confusion_matrix(scored: DataFrame, keys: Sequence[str], truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    """Long form: one row per (truth, prediction) pair that occurs."""
    return scored.groupBy(*keys, truth, prediction).agg(F.count("*").alias("n"))


def dual_polarity(counts: DataFrame) -> DataFrame:
    """Metrics with spam as 1 and with the truth flipped, from one set of counts.

    Flipping the truth swaps ``tp`` with ``fp`` and ``fn`` with ``tn``.
    """
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    return counts.withColumns({
        "accuracy_spam_1": ratio(tp + tn, n),
        "precision_spam_1": ratio(tp, tp + fp),
        "recall_spam_1": ratio(tp, tp + fn),
        "accuracy_spam_0": ratio(fp + fn, n),
        "precision_spam_0": ratio(fp, tp + fp),
        "recall_spam_0": ratio(fp, fp + tn),
    })


def invert_predictions(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Predictions read the other way round: cluster 0 as spam."""
    return scored.withColumn(prediction, 1 - F.col(prediction))


def invert_counts(counts: DataFrame) -> DataFrame:
    """Confusion counts of predictions read the other way round."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({"tp": fn, "fp": tn, "fn": tp, "tn": fp})


def error_rate(scored: DataFrame, keys: Sequence[str], truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(*keys).agg(
        F.avg((F.col(prediction) != F.col(truth)).cast("double")).alias("error_rate")
    )


def batch_report(metrics: DataFrame) -> DataFrame:
    """What a training run prints for a batch: metrics to three decimals and the matrix."""
    return metrics.select(
        "model", "batch_no", F.col("n").alias("batch_size"),
        *[F.format_number(c, 3).alias(c) for c in ("accuracy", "precision", "recall")],
        F.format_string("[[%d %d] [%d %d]]", "tn", "fp", "fn", "tp").alias("confusion_matrix"),
    )


def cluster_report(log: DataFrame) -> DataFrame:
    """What a training run of the clusterer prints for a batch: metrics and matrix with
    spam as 1, and again with the truth flipped, from its log."""
    metrics = [f"{m}_spam_{s}" for s in (1, 0) for m in ("accuracy", "precision", "recall")]
    return log.select(
        "model", "batch_no", F.col("n").alias("batch_size"), *[F.format_number(c, 3).alias(c) for c in metrics],
        F.format_string("[[%d %d] [%d %d]]", "tn", "fp", "fn", "tp").alias("confusion_matrix_spam_1"),
        F.format_string("[[%d %d] [%d %d]]", "fn", "tp", "tn", "fp").alias("confusion_matrix_spam_0"),
    )

"""Logs as headed CSV files in a folder per model.

``<root>/<model>/TrainLogs/logs.csv`` holds one line per batch;
``<root>/<model>/TestLogs/logs.csv`` one line per scored record for the final
model, and ``logs<N>.csv`` the same for the model saved after batch N.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.models import ALL_MODELS, CLUSTERING

# Header names of the log files.
TRAIN_HEADER = {"batch_no": "BatchNum", "accuracy": "Accuracy", "precision": "Precision", "recall": "Recall"}
CLUSTER_HEADER = {
    "batch_no": "batchNum",
    **{f"{m}_spam_{s}": f"{m}_spam_{s}" for s in (1, 0) for m in ("accuracy", "precision", "recall")},
}
TEST_HEADER = {"batch_no": "BatchNum", "prediction": "Prediction", "truth": "GroundTruth"}

#: Batches of a test log that are written by one task, and test logs put in place at a time.
PART_BATCHES, FILES_AT_ONCE = 1000, 16

_INTEGERS = {"batch_no", "prediction", "truth"}


def checkpoint_number(path: Column, last: int | Column) -> Column:
    """N of a file named ``logsN.csv``; ``last`` for the bare ``logs.csv``."""
    digits = F.regexp_extract(path, r"logs(\d*)\.csv", 1)
    return F.when(digits == "", F.lit(last)).otherwise(digits.try_cast("int"))


def _model_of(path: Column) -> Column:
    return F.url_decode(F.regexp_extract(path, r"([^/]+)/(?:Train|Test)Logs/", 1))


def _read(
    spark: SparkSession, paths: Sequence[str], header: dict[str, str], models: Sequence[str], **told: Column
) -> DataFrame:
    """The lines of logs with their ``model`` and what else is ``told`` by the name of their
    ``file``, which is looked at once and not for every line."""
    schema = ", ".join(f"{c} {'int' if c in _INTEGERS else 'double'}" for c in header)
    file, path = F.col("file"), F.col("_metadata.file_path").alias("file")
    # Grouped, since a condition on an expression of the file would be carried over to the lines.
    files = spark.read.format("binaryFile").load(list(paths)).select(path).groupBy("file").agg(
        *[F.first(c).alias(n) for n, c in {"model": _model_of(file), **told}.items()]
    )
    lines = spark.read.schema(schema).csv(list(paths), header=True, enforceSchema=True).select("*", path)
    return lines.join(F.broadcast(files.filter(F.col("model").isin(list(models)))), "file").drop("file")


def read_train_logs(spark: SparkSession, root: str, models: Sequence[str]) -> DataFrame:
    """Training logs of the named classifiers; folders of other names are passed over."""
    return _read(spark, [f"{root}/*/TrainLogs/logs.csv"], TRAIN_HEADER, models)


def read_cluster_log(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, [f"{root}/{CLUSTERING}/TrainLogs/logs.csv"], CLUSTER_HEADER, [CLUSTERING])


def read_test_logs(
    spark: SparkSession, root: str, last: int, models: Sequence[str] = ALL_MODELS
) -> DataFrame:
    """Test logs of every checkpoint: ``model, checkpoint, batch_no, prediction, truth, is_final``."""
    logs = _read(
        spark, [f"{root}/*/TestLogs/logs*.csv"], TEST_HEADER, models, checkpoint=checkpoint_number(F.col("file"), last),
        is_final=F.regexp_like("file", F.lit(r"logs\.csv")),
    )
    return logs.select("model", "checkpoint", "batch_no", "prediction", "truth", "is_final")


def write_csv_log(log: DataFrame, path: str, header: dict[str, str]) -> None:
    """Write a log under ``path`` with the header names of its kind."""
    log.select(*[F.col(c).alias(h) for c, h in header.items()]).write.mode("overwrite").csv(path, header=True)


def export_csv_logs(
    root: str, train: DataFrame | None = None, clusters: DataFrame | None = None, test: DataFrame | None = None
) -> None:
    """Write log tables in the folder layout above.

    ``test`` has ``model`` and ``checkpoint``, where checkpoint 0 is the final model.
    """
    if train is not None:
        for model in sorted(r.model for r in train.select("model").distinct().collect()):
            write_csv_log(train.filter(F.col("model") == model), f"{root}/{model}/TrainLogs/logs.csv", TRAIN_HEADER)
    if clusters is not None:
        write_csv_log(clusters, f"{root}/{CLUSTERING}/TrainLogs/logs.csv", CLUSTER_HEADER)
    if test is not None:
        _export_test_logs(root, test)


def _export_test_logs(root: str, test: DataFrame) -> None:
    """All test logs in one pass, a folder each, which then takes its place."""
    spark = test.sparkSession
    staged = f"{root}/_test-logs-{uuid.uuid4().hex}"
    kept = test.filter(F.col("model").isNotNull() & F.col("checkpoint").isNotNull())
    placed = kept.repartition("model", "checkpoint", F.floor(F.col("batch_no") / PART_BATCHES))
    (placed.select("model", "checkpoint", *[F.col(c).alias(h) for c, h in TEST_HEADER.items()])
     .write.partitionBy("model", "checkpoint").csv(staged, header=True))
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f.getPath() for m in store.listStatus(path(staged)) if m.isDirectory() for f in store.listStatus(m.getPath())]

    def put(folder):
        model, checkpoint = (unquote(f.getName().split("=", 1)[1]) for f in (folder.getParent(), folder))
        to = path(f"{root}/{model}/TestLogs/logs{checkpoint if checkpoint != '0' else ''}.csv")
        store.mkdirs(to.getParent())
        store.delete(to, True)
        if not store.rename(folder, to):
            raise OSError(f"{to} could not be written")

    with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
        list(pool.map(put, folders))
    store.delete(path(staged), True)

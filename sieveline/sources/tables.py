"""Datasets: parquet tables, headed CSV files and plain line files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batching import number_rows_by_range
from ..session import spread
from .csv_records import OPTIONS, csv_records, parsed


def load(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def labelled_messages(spark: SparkSession, data_dir: str) -> DataFrame:
    """``documents`` with a label, shaped as subject, message and label."""
    documents = spread(load(spark, data_dir, "documents").select("doc_id", "lang", "text"))
    labels = load(spark, data_dir, "labels").select("doc_id", "toxic")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.col("lang").alias("feature0"),
        F.col("text").alias("feature1"),
        F.when(F.col("toxic") == 1, "spam").otherwise("ham").alias("feature2"),
    )


def is_test_row(row_id: Column) -> Column:
    """Every fifth row is held out."""
    return row_id % 5 == 0


def dataset_split(rows: DataFrame, mode: str = "train") -> DataFrame:
    """The training rows, or in test mode always the held-out rows."""
    if mode not in ("train", "test"):
        raise ValueError(f"mode must be 'train' or 'test', not {mode!r}")
    held_out = is_test_row(F.col("row_id"))
    return rows.filter(held_out if mode == "test" else ~held_out)


def csv_scan(spark: SparkSession, path: str | Sequence[str], n_columns: int = 3) -> DataFrame:
    """Headed CSV read by position into string columns ``feature0..``, a task a file, in the
    file's order; :func:`csv_split_scan` has the same rows from many tasks.

    Quoted fields may span lines.  The schema is fixed, so nothing is inferred.
    """
    names = [f"feature{i}" for i in range(n_columns)]
    return spark.read.schema(", ".join(f"{n} string" for n in names)).csv(
        path, header=True, enforceSchema=True, **OPTIONS
    )


def csv_split_scan(spark: SparkSession, path: str | Sequence[str], n_columns: int = 3) -> DataFrame:
    """The rows of :func:`csv_scan`, in no order; a large file is read by many tasks."""
    return parsed(csv_records(spark, path), n_columns).drop("file", "record")


def csv_rows(spark: SparkSession, path: str | Sequence[str], n_columns: int = 3) -> DataFrame:
    """:func:`csv_split_scan` with ``row_id``: the place of the row, files in order of their names."""
    numbered = number_rows_by_range(parsed(csv_records(spark, path), n_columns), ["file", "record"])
    return numbered.withColumnRenamed("row_no", "row_id").drop("file", "record", "n_rows")


def text_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with the position they were read from: ``file, line_key, line``.

    ``line_key`` rises with the line's place in its file: the scan hands out the
    splits of a file in order only within a partition, so the byte offset of the
    split comes first and the position inside it second.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_key"),
        F.col("value").alias("line"),
    )

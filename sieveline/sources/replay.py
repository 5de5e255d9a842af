"""A replayed dataset on disk and as a stream: payload lines in order of their batches.

Payload lines that say no batch number, in a folder of text files, are numbered by their
place and become a log like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.payloads import decode_columnar
from ..session import materialize
from .csv_records import block_runs, with_block_numbers
from .payload_log import read_batches, read_log, stream_log, write_log


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Write ``batch_no, payload`` as a log of payload lines."""
    write_log(payloads, path)


def write_plain(payloads: DataFrame, path: str) -> None:
    """Write the payloads alone as text files, in order of their batches."""
    payloads.repartitionByRange("batch_no").sortWithinPartitions("batch_no", "payload").select("payload").write.text(path)


def number_plain(spark: SparkSession, folder: str, path: str) -> None:
    """Make a log of a folder of payload lines without batch numbers.

    Every line that is not empty is a batch; files count in order of their names and
    lines in order of their place.  Lines are counted by block, and each block then
    numbers its own and writes them where it reads them, so no text is shuffled.
    """
    lines = spark.read.option("lineSep", "\n").text(folder).filter("value != ''").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    counts = materialize(lines.groupBy("file", "block").agg(F.count("*").alias("n")), "line-blocks")
    # A block is a row: the literal partition names the single group of the running sum.
    before = Window.partitionBy(F.lit(0)).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def number(batches):
        at, line = None, 0
        for batch in batches:
            numbers, first = np.zeros(batch.num_rows, dtype=np.int64), batch.column("first").to_numpy()
            for low, high, block in block_runs(batch):
                if block != at:
                    at, line = block, int(first[low])
                numbers[low:high] = np.arange(line + 1, line + 1 + high - low)
                line += high - low
            yield pa.RecordBatch.from_arrays([pa.array(numbers), batch.column("value")], names=["batch_no", "payload"])

    write_log(with_block_numbers(lines, starts).mapInArrow(number, "batch_no long, payload string"), path, in_order=True)


def payload_stream(
    spark: SparkSession, path: str, batches_per_trigger: int = 1, progress: str | None = None
) -> DataFrame:
    """Rows of a log as a stream: ``batch_no, row_in_batch, feature0..``, that many batches
    to a micro-batch.  ``progress`` is as in :func:`.payload_log.stream_log`."""
    return decode_columnar(stream_log(spark, path, batches_per_trigger, progress), keep=["batch_no"])


def payload_rows(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The same rows as a static table, of all batches or of those from ``first`` to ``last``."""
    lines = read_log(spark, path) if first is None else read_batches(spark, path, first, last)
    return decode_columnar(lines, keep=["batch_no"])


class Replay:
    """A started query on a log; awaiting it means to wait until the log is used up."""

    def __init__(self, query: StreamingQuery):
        self.query = query

    def awaitTermination(self) -> None:
        try:
            self.query.processAllAvailable()
        finally:
            self.query.stop()

    def __getattr__(self, name: str):
        return getattr(self.query, name)

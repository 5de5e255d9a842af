"""Headed CSV with quoted fields over several lines, one file read by many tasks.

A file is read as physical lines in blocks.  Whether a line break ends a record depends
on how many quotes stand before it in the file, odd or even.  A first pass counts, per
block, its quotes and how many records start in it if it begins outside or inside a
field; running sums over the few numbers of each block then say what every block
begins with.  A second pass numbers the records of its own block by that.  Records of
one line, nearly all, never move; the lines of the others, which may lie in two
blocks, are gathered by their number.

A quote that is never closed makes the rest of its file one field, as it does for
any reader of CSV.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.batching import MAX_BUCKETS
from ..session import materialize

#: How the reader and a parsed record treat quotes and line ends within fields.
OPTIONS = {"escape": '"', "multiLine": True}

_AT = ["file", "block"]


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Physical lines with their block and the number of their quotes, in order within a block."""
    value = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))).alias("quotes"), "value",
    )


def block_runs(batch: pa.RecordBatch):
    """Ranges of rows of one block: where they start and end, the file and the block."""
    files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
    edges = [0] + [i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]] + [len(files)]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield low, high, (files[low], blocks[low])


def _inside(batch: pa.RecordBatch, low: int, high: int, begins: int) -> np.ndarray:
    """0 or 1 for every line and for what follows the last: whether it starts within a field."""
    odd = batch.column("quotes").to_numpy()[low:high] & 1
    return (begins + np.append(0, np.cumsum(odd))) & 1


def _block_counts(lines: DataFrame) -> DataFrame:
    """``file, block, odd, outside, inside``: parity of the block's quotes, and records that
    start in it if it begins outside or inside a field."""
    def count(batches):
        at, seen, odd = None, [0, 0], 0
        for batch in batches:
            for low, high, block in block_runs(batch):
                if block != at:
                    if at is not None:
                        yield report(at, odd, seen)
                    at, seen, odd = block, [0, 0], 0
                within = _inside(batch, low, high, odd)
                ones = int(within[:-1].sum())
                seen = [seen[0] + high - low - ones, seen[1] + ones]
                odd = int(within[-1])
        if at is not None:
            yield report(at, odd, seen)

    def report(at, odd, seen):
        return pa.RecordBatch.from_pydict({
            "file": [at[0]], "block": pa.array([at[1]], type=pa.int64()), "odd": pa.array([odd], type=pa.int64()),
            "outside": pa.array([seen[0]], type=pa.int64()), "inside": pa.array([seen[1]], type=pa.int64()),
        })

    return lines.select("file", "block", "quotes").mapInArrow(
        count, "file string, block long, odd long, outside long, inside long"
    )


def _block_starts(counts: DataFrame) -> DataFrame:
    """``file, block, begins, first``: what each block begins with, and records before it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.withColumn("begins", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    started = F.when(F.col("begins") == 0, F.col("outside")).otherwise(F.col("inside"))
    return begun.withColumn("started", started).select(
        "file", "block", "begins", F.coalesce(F.sum("started").over(before), F.lit(0)).alias("first")
    )


def with_block_numbers(lines: DataFrame, numbers: DataFrame) -> DataFrame:
    """``lines`` with the few numbers of their ``file, block``, still in order within a block."""
    if numbers.count() <= MAX_BUCKETS:
        return lines.join(F.broadcast(numbers), _AT)
    # The lines of a block meet its numbers in one task, in the order they were read in.
    ordered = lines.withColumn("read", F.monotonically_increasing_id())
    return ordered.join(numbers, _AT).repartition(*_AT).sortWithinPartitions(*_AT, "read").drop("read")


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, record, text``: the records of the files after their headers, numbered from 1
    in each file.  Empty lines between records are no records but count."""
    lines = _lines(spark, path)
    starts = materialize(_block_starts(_block_counts(lines)), "csv-blocks")
    placed = with_block_numbers(lines, starts)

    def number(batches):
        at, within, record, line = None, 0, 0, 0
        for batch in batches:
            records, places, alone = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            begins, first = batch.column("begins").to_numpy(), batch.column("first").to_numpy()
            for low, high, block in block_runs(batch):
                if block != at:
                    at, within, record, line = block, int(begins[low]), int(first[low]) - 1, 0
                inside = _inside(batch, low, high, within)
                records[low:high] = record + np.cumsum(inside[:-1] == 0)
                places[low:high] = np.arange(line, line + high - low)
                alone[low:high] = (inside[:-1] == 0) & (inside[1:] == 0)
                within, record, line = int(inside[-1]), int(records[high - 1]), line + high - low
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), batch.column("value"), pa.array(records), pa.array(places),
                 pa.array(alone.astype(bool))], names=["file", "block", "value", "record", "place", "alone"],
            )

    numbered = placed.mapInArrow(
        number, "file string, block long, value string, record long, place long, alone boolean"
    ).filter("record > 0")
    single = numbered.filter("alone AND trim(both '\r' from value) != ''").select("file", "record", F.col("value").alias("text"))
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "value")))  # the lines of one record
    several = numbered.filter("NOT alone").groupBy("file", "record").agg(parts.alias("parts")).select(
        "file", "record", F.array_join("parts.value", "\n").alias("text")
    )
    return single.unionByName(several)


def parsed(records: DataFrame, n_columns: int) -> DataFrame:
    """``file, record`` and the fields of each record by position, as ``feature0..``."""
    schema = ", ".join(f"feature{i} string" for i in range(n_columns))
    text = F.regexp_replace("text", "\r$", "")
    return records.select("file", "record", F.from_csv(text, schema, OPTIONS).alias("fields")).select("file", "record", "fields.*")

"""A stream source over an ordered log of payload lines, whose offsets are batch numbers.

A log is a folder with ``lines``, Parquet files of ``batch_no, payload`` in order of the
batches, many batches to a file, and ``index``, a row for every row group of the lines:
its file, its place there, and its first and last batch.  The source hands out the
next batches by their numbers alone, so neither file names nor file times have a part
in the order, and reads only the row groups that hold them.  How many files there are
follows from the bytes of the log, and what the driver does for a micro-batch from
the batches in it.  A log can be replayed several times or without end; batch numbers
then count on from one time to the next.

The log is read by pyarrow's file systems, which know local paths and the common stores.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "payload_log"
SCHEMA = "batch_no long, payload string"
_INDEX = "file string, row_group int, first_batch long, last_batch long"
_LAYOUT = pa.schema([("batch_no", pa.int64()), ("payload", pa.string())])

#: Bytes of a row group, what one task of a micro-batch reads, and lines between two looks at its size.
GROUP_BYTES, GROUP_LINES = 1 << 20, 4


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def write_log(lines: DataFrame, path: str, in_order: bool = False) -> None:
    """Write ``batch_no, payload`` as a log: one pass for the lines, and one over the
    footers of their files for the index.  The index comes last: a log is whole or
    cannot be read.  Lines that are ``in_order`` in every partition are written as they are."""
    kept = lines.select("batch_no", "payload")
    if not in_order:
        kept = kept.repartitionByRange("batch_no").sortWithinPartitions("batch_no", "payload")
    (kept.write.option("parquet.block.size", GROUP_BYTES).option("parquet.block.size.row.check.min", GROUP_LINES)
     .parquet(f"{path}/lines"))
    spark = lines.sparkSession

    def footers(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, name = _open(file)
                with store.open_input_file(name) as opened:
                    footer = pq.ParquetFile(opened).metadata
                at = footer.schema.to_arrow_schema().names.index("batch_no")
                numbers = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups)]
                yield pa.RecordBatch.from_pylist(
                    [{"file": file, "row_group": i, "first_batch": s.min, "last_batch": s.max} for i, s in enumerate(numbers)],
                    schema=pa.schema([("file", pa.string()), ("row_group", pa.int32()), ("first_batch", pa.int64()), ("last_batch", pa.int64())]),
                )

    files = spark.read.parquet(f"{path}/lines").select(F.col("_metadata.file_path").alias("file")).distinct()
    files.mapInArrow(footers, _INDEX).write.parquet(f"{path}/index")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a log as a static table."""
    return spark.read.schema(SCHEMA).parquet(f"{path}/lines")


def read_batches(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The lines of some batches as a static table, a task for each row group that has any."""
    spark.dataSource.register(PayloadLog)
    return (
        spark.read.format(FORMAT).option("path", path).option("after", first - 1).option("upto", last).load()
    )


def stream_log(
    spark: SparkSession, path: str, batches_per_trigger: int, progress: str | None = None, epochs: int = 1
) -> DataFrame:
    """The lines of a log as a stream, that many batch numbers to a micro-batch.

    ``progress`` is the checkpoint location of the query if it may be started again: it
    tells where the last run stopped.  The whole log comes ``epochs`` times, or again and
    again for 0, until the query is stopped.
    """
    if batches_per_trigger < 1:
        raise ValueError("batches_per_trigger must be at least 1")
    if epochs < 0:
        raise ValueError("epochs must be 0 or more")
    spark.dataSource.register(PayloadLog)
    return (
        spark.readStream.format(FORMAT).option("path", path).option("batches", batches_per_trigger)
        .option("progress", progress or "").option("epochs", epochs).load()
    )


class PayloadLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        options = self.options
        return LogReader(options["path"], int(options["batches"]), options.get("progress", ""), int(options.get("epochs", 1)))

    def reader(self, schema: StructType) -> DataSourceReader:
        return RangeReader(self.options["path"], int(self.options["after"]), int(self.options["upto"]))


@dataclass
class Piece(InputPartition):
    """Batches above ``after`` up to ``upto`` in one row group, and what their numbers are raised by."""

    file: str
    row_group: int
    after: int
    upto: int
    raised: int = 0


def _index(path: str) -> pa.Table:
    store, folder = _open(f"{path}/index")
    index = ds.dataset(folder, filesystem=store, format="parquet").to_table()
    return index.sort_by([("first_batch", "ascending"), ("file", "ascending"), ("row_group", "ascending")])


def _pieces(index: pa.Table, after: int, upto: int, raised: int = 0) -> list[Piece]:
    asked = index.filter(pc.and_(pc.less_equal(index["first_batch"], upto), pc.greater(index["last_batch"], after)))
    return [Piece(f, g, after, upto, raised) for f, g in zip(asked["file"].to_pylist(), asked["row_group"].to_pylist())]


def _lines(partition: Piece) -> Iterator[pa.RecordBatch]:
    store, name = _open(partition.file)
    with store.open_input_file(name) as opened:
        group = pq.ParquetFile(opened).read_row_group(partition.row_group, columns=_LAYOUT.names)
    number = group["batch_no"]
    asked = group.filter(pc.and_(pc.greater(number, partition.after), pc.less_equal(number, partition.upto)))
    asked = asked.set_column(0, "batch_no", pc.add(asked["batch_no"], partition.raised))
    yield from asked.cast(_LAYOUT).to_batches(max_chunksize=64)


class RangeReader(DataSourceReader):
    """The batches above ``after`` up to ``upto``."""

    def __init__(self, path: str, after: int, upto: int):
        self.path, self.after, self.upto = path, after, upto

    def partitions(self) -> list[Piece]:
        return _pieces(_index(self.path), self.after, self.upto)

    def read(self, partition: Piece | None) -> Iterator[pa.RecordBatch]:
        return _lines(partition) if partition else iter(())  # no pieces at all: one call without any


class LogReader(DataSourceStreamReader):
    """Offsets are ``{"batch": n}``: everything up to batch n has been handed out."""

    def __init__(self, path: str, batches: int, progress: str, epochs: int = 1):
        self.index = _index(path)
        self.batches = batches
        self.first = pc.min(self.index["first_batch"]).as_py() or 1
        self.last = pc.max(self.index["last_batch"]).as_py() or 0
        self.length = max(self.last - self.first + 1, 0)
        # With an empty log, no time adds anything.
        self.end = self.first - 1 + epochs * self.length if epochs or not self.length else None
        self.at = max(self.first - 1, self._handed_out(progress)) if progress else self.first - 1

    def _handed_out(self, progress: str) -> int:
        """The last offset in the query's offset log, whose newest file ends in it."""
        store, folder = _open(f"{progress}/offsets")
        found = store.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        numbered = {int(f.base_name): f.path for f in found if f.base_name.isdigit()}
        if not numbered:
            return self.first - 1
        with store.open_input_stream(numbered[max(numbered)]) as opened:
            return json.loads(opened.read().decode().strip().splitlines()[-1])["batch"]

    def initialOffset(self) -> dict:
        return {"batch": self.first - 1}

    def latestOffset(self) -> dict:
        upto = self.at + self.batches
        return {"batch": upto if self.end is None else max(self.at, min(self.end, upto))}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        after, upto = start["batch"], end["batch"]
        self.at = max(self.at, upto)
        pieces = []
        while after < upto:
            raised = (after - self.first + 1) // self.length * self.length
            last = min(upto, raised + self.last)
            pieces += _pieces(self.index, after - raised, last - raised, raised)
            after = last
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return _lines(partition)

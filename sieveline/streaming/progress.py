"""What streaming queries did, as a table: their start, every micro-batch, and their end."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

EVENTS = "event string, run string, epoch_id long, rows long"

#: Name of the observed number of rows.
OBSERVED = "arrived"


def observed(rows: DataFrame) -> DataFrame:
    """``rows``, counted as they pass."""
    return rows.observe(OBSERVED, F.count(F.lit(1)).alias("rows"))


class Progress(StreamingQueryListener):
    """Notes the events of all queries of a session while it is in a ``with`` block.

    A micro-batch is one short row; ``rows`` is the observed count of :func:`observed`
    streams, else the number of rows that the sources gave.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.rows: list[tuple] = []
        self.ended = threading.Condition()

    def __enter__(self) -> Progress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        """Events come a little later than what they tell of: wait for the last ends."""
        limit = time.monotonic() + 10
        with self.ended:
            while self._running() and time.monotonic() < limit:
                self.ended.wait(0.2)
        self.spark.streams.removeListener(self)

    def _running(self) -> set[str]:
        runs = lambda event: {r[1] for r in self.rows if r[0] == event}
        return runs("started") - runs("terminated")

    def _note(self, event: str, run, epoch_id: int | None = None, rows: int | None = None) -> None:
        with self.ended:
            self.rows.append((event, str(run), epoch_id, rows))
            self.ended.notify_all()

    def onQueryStarted(self, event) -> None:
        self._note("started", event.runId)

    def onQueryProgress(self, event) -> None:
        told = event.progress
        seen = told.observedMetrics.get(OBSERVED)
        self._note("progress", told.runId, told.batchId, seen.rows if seen else told.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._note("terminated", event.runId)

    def table(self) -> DataFrame:
        """``event, run, epoch_id, rows`` so far."""
        return self.spark.createDataFrame(self.rows, EVENTS)

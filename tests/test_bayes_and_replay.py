"""Sums in Spark's state, logs replayed several times, and what queries report of themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from sieveline.operators.batching import batch_table
from sieveline.operators.models import NAIVE_BAYES
from sieveline.operators.payloads import encode_columnar
from sieveline.session import work_dir
from sieveline.sources.payload_log import LogReader, read_batches, read_log, stream_log, write_log
from sieveline.sources.replay import Replay
from sieveline.sources.tables import labelled_messages
from sieveline.streaming.bayes import stream_bayes
from sieveline.streaming.progress import Progress
from sieveline.streaming.store import Store
from sieveline.streaming.train import stream_train


@pytest.fixture(scope="module")
def lines(spark):
    """87 messages in five batches."""
    made = encode_columnar(batch_table(labelled_messages(spark, SMALL), "row_id", 20))
    path = work_dir(spark, "lines")
    write_log(made, path)
    return path


def new_store(spark):
    store = Store(spark, work_dir(spark, "bayes"))
    store.create()
    return store


def log(store):
    return sorted(tuple(r[c] for c in ("batch_no", "n", "tp", "fp", "fn", "tn")) for r in store.train_log().collect())


@pytest.mark.parametrize("per_trigger", [1, 64])
def test_state_equals_sums_on_the_driver_and_survives_a_restart(spark, lines, per_trigger):
    whole = new_store(spark)
    stream_train(spark, lines, whole.root, models=(NAIVE_BAYES,)).awaitTermination()
    store = new_store(spark)
    for upto in (2, 5):  # the log grows while the query is not running
        path = work_dir(spark, "grown")
        write_log(read_log(spark, lines).filter(F.col("batch_no") <= upto), path)
        stream_bayes(spark, path, store.root, batches_per_trigger=per_trigger).awaitTermination()
        assert store.last_batch() == upto
    assert log(store) == log(whole)
    for n in range(1, 6):
        made, expected = store.load_states(n)[NAIVE_BAYES], whole.load_states(n)[NAIVE_BAYES]
        np.testing.assert_allclose(made.params, expected.params, atol=1e-9)


def test_a_log_comes_several_times(spark, lines):
    reader = LogReader(lines, 3, "", epochs=3)
    ends, got = [reader.initialOffset()["batch"]], []
    while (upto := reader.latestOffset()["batch"]) != ends[-1]:
        for piece in reader.partitions({"batch": ends[-1]}, {"batch": upto}):
            for batch in reader.read(piece):
                got += [(n, p) for n, p in zip(*(c.to_pylist() for c in batch.columns))]
        ends.append(upto)
    once = {r.batch_no: r.payload for r in read_log(spark, lines).collect()}
    assert ends == [0, 3, 6, 9, 12, 15]
    assert sorted(got) == [(5 * e + n, once[n]) for e in range(3) for n in range(1, 6)]


def test_a_log_without_end_and_an_empty_one(spark, lines):
    endless = LogReader(lines, 7, "", epochs=0)
    for upto in (7, 14, 21):
        assert endless.latestOffset() == {"batch": upto}
        endless.partitions({"batch": upto - 7}, {"batch": upto})
    path = work_dir(spark, "none")
    write_log(read_log(spark, lines).limit(0), path)
    empty = LogReader(path, 7, "", epochs=0)
    assert empty.latestOffset() == empty.initialOffset()
    with pytest.raises(ValueError):
        stream_log(spark, lines, 1, epochs=-1)


def test_progress_of_good_and_broken_queries(spark, lines):
    def fails(df, epoch_id):
        raise RuntimeError("lost")

    with Progress(spark) as progress:
        for learn in (lambda df, i: df.count(), fails):
            query = stream_log(spark, lines, 2).writeStream.foreachBatch(learn).option(
                "checkpointLocation", work_dir(spark, "progress")).start()
            try:
                Replay(query).awaitTermination()
            except Exception:
                assert learn is fails
    rows = progress.table().collect()
    counts = {e: sum(r.event == e for r in rows) for e in ("started", "terminated")}
    assert counts == {"started": 2, "terminated": 2}
    assert [r.epoch_id for r in rows if r.event == "progress" and r.rows] == [0, 1, 2]


def test_some_batches_are_read_by_row_groups(spark, lines):
    """The same lines as a filter of the whole log gives, a task for each row group that has any."""
    whole = {r.batch_no: r.payload for r in read_log(spark, lines).collect()}
    for first, last in ((1, max(whole)), (2, 2), (2, 3), (max(whole), max(whole) + 5), (max(whole) + 1, max(whole) + 2)):
        made = read_batches(spark, lines, first, last)
        assert {r.batch_no: r.payload for r in made.collect()} == {b: p for b, p in whole.items() if first <= b <= last}
        groups = spark.read.parquet(f"{lines}/index").filter(f"first_batch <= {last} and last_batch >= {first}").count()
        assert not groups or made.rdd.getNumPartitions() == groups

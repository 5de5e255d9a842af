import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from sieveline.operators.batching import batch_table
from sieveline.operators.features import featurize
from sieveline.operators.models import CLASSIFIERS, CLUSTERING, LOGISTIC, NAIVE_BAYES
from sieveline.operators.payloads import encode_columnar
from sieveline.session import shared_dir, work_dir
from sieveline.sources.payload_log import LogReader, write_log
from sieveline.sources.replay import Replay, payload_rows, payload_stream, write_payloads, write_plain
from sieveline.sources.tables import labelled_messages
from sieveline.streaming import store as S
from sieveline.streaming.scoring import Scorer, run, stream_test
from sieveline.streaming.store import CLUSTER_FAMILY, FAMILIES, Store
from sieveline.streaming.train import Trainer, stream_train


@pytest.fixture(scope="module")
def payload_dir(spark):
    """87 messages in four batches of 20."""
    path = work_dir(spark, "test-payloads")
    write_payloads(encode_columnar(batch_table(labelled_messages(spark, SMALL), "row_id", 20, keep_tail=False)), path)
    return path


def new_store(spark, family="classifiers"):
    store = Store(spark, work_dir(spark, "test-run"), family)
    store.create()
    return store, store.root


@pytest.fixture(scope="module")
def finished(spark, payload_dir):
    store, root = new_store(spark)
    stream_train(spark, payload_dir, root).awaitTermination()
    return store


def params(store):
    return {(r.batch_no, r.model): np.array(r.params) for r in store.models().collect()}


def log(store):
    return sorted(tuple(r[c] for c in ("model", "batch_no", "epoch_id", "tp", "fp", "fn", "tn")) for r in store.train_log().collect())


def test_the_session_names_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named
    assert spark.sparkContext.getCheckpointDir() is not None


def arrivals(spark, path, per_trigger, progress):
    order = []
    query = (payload_stream(spark, path, per_trigger, progress).writeStream
             .foreachBatch(lambda df, i: order.append(sorted(r[0] for r in df.select("batch_no").distinct().collect())))
             .option("checkpointLocation", progress).start())
    Replay(query).awaitTermination()
    return order


def test_batches_arrive_in_order(spark, payload_dir):
    assert arrivals(spark, payload_dir, 1, work_dir(spark, "order")) == [[1], [2], [3], [4]]
    assert arrivals(spark, payload_dir, 3, work_dir(spark, "order")) == [[1, 2, 3], [4]]


def test_a_grown_log_goes_on_after_its_end(spark, payload_dir):
    """The same query on more batches hands out only the new ones."""
    progress, path = work_dir(spark, "order"), work_dir(spark, "grown")
    lines = spark.read.parquet(f"{payload_dir}/lines")
    for upto, expected in ((2, [[1, 2]]), (2, []), (4, [[3, 4]])):
        write_log(lines.filter(F.col("batch_no") <= upto), f"{path}-{upto}-{len(expected)}")
        order = arrivals(spark, f"{path}-{upto}-{len(expected)}", 2, progress)
        assert order == expected


def test_files_do_not_grow_with_batches(spark):
    """Two thousand batches of one line: few files, and each micro-batch reads only its row groups."""
    path = work_dir(spark, "many")
    lines = spark.range(1, 2001).selectExpr(
        "id AS batch_no", "array_join(transform(sequence(1, 300), i -> sha2(concat(id, '-', i), 256)), '') AS payload"
    )
    write_log(lines, path)
    index = spark.read.parquet(f"{path}/index")
    assert index.select("file").distinct().count() <= 8 < index.count() and index.agg(F.min("first_batch"), F.max("last_batch")).first() == (1, 2000)
    reader = LogReader(path, 100, "")
    asked = reader.partitions({"batch": 700}, {"batch": 800})
    assert 1 <= len(asked) <= 3
    got = [n for piece in asked for batch in reader.read(piece) for n in batch.column(0).to_pylist()]
    assert sorted(got) == list(range(701, 801))
    assert reader.latestOffset() == {"batch": 900} and reader.partitions({"batch": 2000}, {"batch": 2000}) == []
    with pytest.raises(ValueError):
        payload_stream(spark, path, 0)


def test_training_logs_every_model_and_batch(finished):
    assert {(r.model, r.batch_no, r.n) for r in finished.train_log().collect()} == {
        (m, b, 20) for m in CLASSIFIERS for b in range(1, 5)
    }
    assert set(params(finished)) == {(b, m) for m in CLASSIFIERS for b in range(1, 5)}
    assert finished.last_batch() == 4


def test_final_and_numbered_models(finished):
    assert {r.batch_no for r in finished.load_models().collect()} == {4}
    assert {r.batch_no for r in finished.load_models(2).collect()} == {2}


@pytest.mark.parametrize("per_trigger, logged", [(1, 2), (2, 2), (16, 0)])
def test_a_broken_run_goes_on_where_it_stopped(spark, payload_dir, finished, per_trigger, logged):
    store, root = new_store(spark)
    original = Trainer._log

    def fails_once(self, features, judged, numbers, epoch_id):
        if 3 in numbers and not fails_once.done:
            fails_once.done = True
            raise RuntimeError("lost")
        return original(self, features, judged, numbers, epoch_id)

    fails_once.done = False
    Trainer._log = fails_once
    try:
        with pytest.raises(Exception):
            stream_train(spark, payload_dir, root, batches_per_trigger=per_trigger).awaitTermination()
        assert store.last_batch() == logged
        stream_train(spark, payload_dir, root, batches_per_trigger=per_trigger).awaitTermination()
    finally:
        Trainer._log = original
    same_run(store, finished)


def same_run(store, other):
    assert [r[:2] + r[3:] for r in log(store)] == [r[:2] + r[3:] for r in log(other)]
    whole, again = params(other), params(store)
    assert set(whole) == set(again)
    for key in whole:
        np.testing.assert_allclose(again[key], whole[key], atol=1e-12)


def test_an_uncommitted_micro_batch_is_done_again(spark, payload_dir, finished):
    """Two batches logged, the second half of the micro-batch's log lost."""
    store, _ = new_store(spark)
    rows = featurize(payload_rows(spark, payload_dir))
    early, late = rows.filter("batch_no <= 2"), rows.filter("batch_no > 2")
    Trainer(store)(early, 0)
    Trainer(store)(late, 1)
    # A new trainer gets micro-batch 1 once more, then nothing is doubled.
    Trainer(store)(late, 1)
    same_run(store, finished)


def test_a_batch_delivered_twice_counts_once(spark, payload_dir):
    store, _ = new_store(spark)
    rows = featurize(payload_rows(spark, payload_dir))
    first = rows.filter(F.col("batch_no") == 1)
    trainer = Trainer(store, models=(NAIVE_BAYES, LOGISTIC))
    trainer(first, 0)
    once = (log(store), params(store))
    trainer(first, 0)
    Trainer(store, models=(NAIVE_BAYES, LOGISTIC))(first, 0)
    assert log(store) == once[0] and set(params(store)) == set(once[1])
    for key, value in params(store).items():
        np.testing.assert_allclose(value, once[1][key], atol=1e-12)
    trainer(rows.filter(F.col("batch_no") == 2), 1)
    assert store.last_batch() == 2


def test_an_empty_batch_leaves_no_trace(spark, payload_dir):
    store, _ = new_store(spark)
    rows = featurize(payload_rows(spark, payload_dir))
    trainer = Trainer(store, models=(NAIVE_BAYES,))
    trainer(rows.limit(0), 0)
    assert store.train_log().count() == 0 and trainer.batch_no == 0
    trainer(rows.filter(F.col("batch_no") == 1), 1)
    assert [r.batch_no for r in store.train_log().collect()] == [1]


def test_scoring_before_fitting(spark, payload_dir):
    """Prequential metrics of batch 2 are those of the model after batch 1."""
    store, _ = new_store(spark)
    rows = featurize(payload_rows(spark, payload_dir))
    trainer = Trainer(store, models=(NAIVE_BAYES,), prequential=True)
    for b in (1, 2):
        trainer(rows.filter(F.col("batch_no") == b), b - 1)
    row = store.train_log().filter("batch_no = 2").first()
    Scorer(store, 1)(rows.filter(F.col("batch_no") == 2), 0)
    scored = store.test_log().agg(F.expr("count_if(prediction = 1 AND truth = 1)"), F.expr("count_if(prediction = 0 AND truth = 0)")).first()
    assert (row.tp, row.tn) == tuple(scored)


def test_a_new_test_run_replaces_the_log(spark, payload_dir, finished):
    root = finished.root
    for _ in range(2):
        stream_test(spark, payload_dir, root).awaitTermination()
    stream_test(spark, payload_dir, root, model_num=2).awaitTermination()
    counts = {(r.checkpoint, r.model): r.n for r in finished.test_log().groupBy("checkpoint", "model").agg(F.count("*").alias("n")).collect()}
    assert counts == {(c, m): 80 for c in (0, 2) for m in CLASSIFIERS}
    with pytest.raises(ValueError):
        stream_test(spark, payload_dir, root, model_num=99)


def test_clustering_has_its_own_run(spark, payload_dir):
    store, root = new_store(spark, CLUSTER_FAMILY)
    run(spark, "train", payload_dir, root, clustering=True).awaitTermination()
    rows = store.train_log().orderBy("batch_no").collect()
    assert [r.batch_no for r in rows] == [1, 2, 3, 4]
    for r in rows:
        assert r.accuracy_spam_1 + r.accuracy_spam_0 == pytest.approx(1)
    run(spark, "test", payload_dir, root, clustering=True).awaitTermination()
    assert store.test_log().count() == 80
    assert store.load_states(4)[CLUSTERING].params[:2].sum() == 80


def test_large_batches_are_learnt_in_shards(spark, payload_dir):
    """Batches of 20 in two shards: other weights, one set of rows per batch."""
    for family, models in FAMILIES.items():
        store, root = new_store(spark, family)
        stream_train(spark, payload_dir, root, clustering=family == CLUSTER_FAMILY, shards=2).awaitTermination()
        assert {(r.batch_no, r.model) for r in store.models().collect()} == {(b, m) for b in range(1, 5) for m in models}
        assert store.train_log().agg(F.sum("n")).first()[0] == 80 * len(models)


def test_plain_lines_are_learnt_in_order_whatever_their_files(spark):
    """30 batches in several files, and in one file that several tasks read."""
    rows = batch_table(labelled_messages(spark, SMALL), "row_id", 3)
    encoded = encode_columnar(rows).cache()
    folders = [work_dir(spark, "test-plain") for _ in range(3)]
    write_payloads(encoded, folders[0])
    write_plain(encoded, folders[1])
    (encoded.coalesce(1).sortWithinPartitions("batch_no").select(F.explode(F.array(F.lit(""), "payload")).alias("payload"))
     .write.text(folders[2]))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        stores = []
        for folder, plain in zip(folders, (False, True, True)):
            store, root = new_store(spark)
            stream_train(spark, folder, root, plain=plain, models=(NAIVE_BAYES,)).awaitTermination()
            stores.append(store)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    for store in stores[1:]:
        assert sorted(r[:2] + r[3:] for r in log(store)) == sorted(r[:2] + r[3:] for r in log(stores[0]))
        whole, again = params(stores[0]), params(store)
        assert set(whole) == set(again)
        for key in whole:
            np.testing.assert_allclose(again[key], whole[key], atol=1e-12)
    stream_train(spark, folders[2], stores[2].root, plain=True, models=(NAIVE_BAYES,)).awaitTermination()  # nothing new
    assert stores[2].last_batch() == 29


def test_chains_give_back_what_was_saved(spark, monkeypatch, payload_dir):
    """Snapshots every third batch, links between, over micro-batches of one and of two."""
    monkeypatch.setattr(S, "SNAPSHOT_EVERY", 3)
    rng = np.random.default_rng(0)
    saved, state = {}, {"a": S.ModelState(rng.normal(size=50), rng.normal(size=4)), "b": S.ModelState(rng.normal(size=7))}
    for n in range(1, 9):
        changed = {m: s.params.copy() for m, s in state.items()}
        changed["a"][rng.integers(0, 50, 5)] = rng.normal(size=5)
        if n % 2:
            changed["b"] = rng.normal(size=7)
        state = {m: S.ModelState(p, rng.normal(size=4) if m == "a" else np.zeros(0), n) for m, p in changed.items()}
        saved[n] = state
    store, _ = new_store(spark)
    before = {}
    for turn, batches in enumerate(([1], [2, 3], [4, 5], [6], [7, 8])):
        store.write_models({n: saved[n] for n in batches}, before, turn, turn)
        store.commit(turn, first_batch=batches[0], batch_no=batches[-1], sent_before=None, sent=batches[-1], shards=1, turn=turn)
        before = saved[batches[-1]]
    whole = {(r.batch_no, r.model): (np.array(r.params), r.steps) for r in store.models().collect()}
    assert set(whole) == {(n, m) for n in saved for m in "ab"}
    for n in saved:
        loaded = store.load_states(n)
        for m, s in saved[n].items():
            np.testing.assert_array_equal(whole[n, m][0], s.params)
            np.testing.assert_array_equal(loaded[m].params, s.params)
            assert loaded[m].steps == n
            np.testing.assert_array_equal(loaded[m].moments, s.moments if n in (6, 8) else np.zeros(0))
    links = {(r.batch_no, r.model): r.slots for r in store._links().collect()}
    assert all((links[n, m] is None) == (n % 3 == 1) for n, m in links) and len(links[2, "a"]) <= 5 and links[2, "b"] == []


def test_reset_keeps_models(spark, payload_dir):
    store, _ = new_store(spark)
    Trainer(store, models=(NAIVE_BAYES,))(featurize(payload_rows(spark, payload_dir)).filter("batch_no = 1"), 0)
    store.reset_logs()
    assert store.train_log().count() == 0 and store.test_log().count() == 0
    assert store.load_models().count() == 1 and store.last_batch() == 1
    Scorer(store)(featurize(payload_rows(spark, payload_dir)), 0)
    assert store.test_log().count() == 80


def test_two_deliveries_both_stay(spark, payload_dir):
    """Two test deliveries with the same numbers add up; a replayed one counts once."""
    store, _ = new_store(spark)
    rows = featurize(payload_rows(spark, payload_dir))
    Trainer(store, models=(NAIVE_BAYES,))(rows.filter("batch_no = 1"), 0)
    scorer = Scorer(store)
    for epoch in (0, 1, 1):
        scorer(rows, epoch)
    assert {(r.batch_no, r["count"]) for r in store.test_log().groupBy("batch_no").count().collect()} == {
        (b, 20) for b in range(1, 9)}


def test_batches_out_of_order_are_rejected(spark, payload_dir):
    store, _ = new_store(spark)
    rows = featurize(payload_rows(spark, payload_dir))
    trainer = Trainer(store, models=(NAIVE_BAYES,))
    trainer(rows.filter("batch_no = 2"), 0)
    for again in (trainer, Trainer(store, models=(NAIVE_BAYES,))):
        with pytest.raises(ValueError, match="came after"):
            again(rows.filter("batch_no = 1"), 1)
    with pytest.raises(ValueError, match="shards"):
        Trainer(store, shards=2, models=(NAIVE_BAYES,))


def test_a_cluster_must_name_the_folder():
    from types import SimpleNamespace

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: None)))


def test_interval_trigger(spark, payload_dir):
    store, root = new_store(spark)
    query = stream_train(spark, payload_dir, root, delay=1, models=(NAIVE_BAYES,))
    query.processAllAvailable()
    query.stop()
    assert store.last_batch() == 4


def test_modes_and_families_are_checked(spark, payload_dir):
    with pytest.raises(ValueError):
        run(spark, "validate", payload_dir, "nowhere")
    with pytest.raises(ValueError):
        Store(spark, "nowhere", "regression")

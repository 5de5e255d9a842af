"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..functions.porter import stem_tokens
from ..functions.vectors import l2_normalize, stem_counts, to_dense
from ..operators import kmeans, metrics, payloads, reports
from ..operators.batching import assign_batches, batch_table, number_rows_by_range, replay_epochs, replay_files
from ..operators.features import feature_entries, featurize
from ..operators.models import CLASSIFIERS, CLUSTERING, LOGISTIC, MLP, NAIVE_BAYES, PERCEPTRON, score, score_checkpoints, slice_of
from ..operators.naive_bayes import class_sums, model_table
from ..operators.sharded import fit_batch, initial_state
from ..session import spread, work_dir
from ..sources import logs
from ..sources.payload_log import read_log, stream_log, write_log
from ..sources.replay import Replay, payload_stream, write_payloads, write_plain
from ..sources.tables import csv_rows, csv_split_scan, is_test_row, labelled_messages, load, text_scan
from ..streaming.bayes import stream_bayes
from ..streaming.progress import Progress
from ..streaming.scoring import stream_test
from ..streaming.store import CLASSIFIER_FAMILY, CLUSTER_FAMILY, Store
from ..streaming.train import BATCHES_PER_TRIGGER, stream_train
from . import datasets as D

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(load(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "lang", "text"))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct kept words of all documents.  Words repeat, so each task removes
    its own repeats before the shuffle."""
    kept = T.remove_stopwords(T.tokenize(T.clean_text(F.col("text"))))
    words = documents(spark, sf_dir).select(F.explode_outer(F.array_distinct(kept)).alias("token"))
    return words.filter(F.col("token").isNotNull()).distinct()


# Text


@query
def concat_joint(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "row_id", T.join_subject_message(F.col("lang"), F.col("text")).alias("joint")
    )


@query
def label_encode(spark, sf_dir):
    return labelled_messages(spark, sf_dir).select("row_id", T.encode_label(F.col("feature2")).alias("y"))


@query
def clean_steps(spark, sf_dir):
    """Each cleaning step on its own, as digests of its whole output."""
    lowered = F.lower("text")
    unescaped = T.strip_escaped_crlf(lowered)
    letters = T.strip_non_alpha(unescaped)
    return documents(spark, sf_dir).select(
        "row_id", F.md5(lowered).alias("lowered"), F.md5(unescaped).alias("unescaped"),
        F.md5(letters).alias("letters"), F.md5(T.collapse_spaces(letters)).alias("collapsed"),
    )


@query
def text_clean(spark, sf_dir):
    return documents(spark, sf_dir).select("row_id", T.clean_text(F.col("text")).alias("cleaned"))


@query
def page_clean(spark, sf_dir):
    """Cleaning of raw web pages, markup and all."""
    pages = spread(load(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", T.clean_text(F.col("html")).alias("cleaned"))


@query
def tokenize(spark, sf_dir):
    tokens = T.tokenize(T.clean_text(F.col("text")))
    return documents(spark, sf_dir).select(
        "row_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


@query
def stopword_filter(spark, sf_dir):
    kept = T.remove_stopwords(T.tokenize(T.clean_text(F.col("text"))))
    return documents(spark, sf_dir).select(
        "row_id", F.size(kept).alias("n_kept"), F.array_join(kept, " ").alias("kept")
    )


@query
def porter_stem(spark, sf_dir):
    return vocabulary(spark, sf_dir).select("token", stem_tokens(F.array("token"))[0].alias("stem"))


@query
def preprocess(spark, sf_dir):
    return documents(spark, sf_dir).select("row_id", T.preprocess(F.col("text")).alias("processed"))


@query
def vectorizer_tokens(spark, sf_dir):
    stems = T.preprocess_tokens(F.col("text"))
    return documents(spark, sf_dir).select(
        "row_id", F.array_join(T.vectorizer_tokens(stems), " ").alias("tokens")
    )


@query
def truncate3(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", T.truncate3(F.col("value")).alias("truncated"))


# Features


@query
def hash_bucket(spark, sf_dir):
    return vocabulary(spark, sf_dir).select(
        "token",
        H.murmur3(F.col("token")).alias("murmur3"),
        H.murmur3_bucket(F.col("token")).alias("bucket"),
        H.md5_bucket(F.col("token")).alias("md5_bucket"),
    )


def _document_counts():
    return stem_counts(T.remove_stopwords(T.tokenize(T.clean_text(F.col("text")))))


@query
def bucket_tf(spark, sf_dir):
    counts = documents(spark, sf_dir).select("row_id", F.inline_outer(_document_counts()))
    return counts.toDF("row_id", "bucket", "tf").filter(F.col("bucket").isNotNull())


@query
def l2_features(spark, sf_dir):
    vectors = documents(spark, sf_dir).select("row_id", l2_normalize(_document_counts()).alias("features"))
    return feature_entries(vectors, "row_id").withColumn("x", F.round("x", 6))


@query
def feature_rows(spark, sf_dir):
    """Labelled messages to sparse vectors and labels."""
    vectors = featurize(labelled_messages(spark, sf_dir))
    return feature_entries(vectors, "row_id", "y").withColumn("x", F.round("x", 6))


@query
def dense_vector(spark, sf_dir):
    return D.batched_features(spark, sf_dir, part="both").select(
        "row_id", F.posexplode_outer(to_dense(F.col("features"))).alias("bucket", "x")
    ).withColumn("x", F.round("x", 6))


# Batches


@query
def batch_assign(spark, sf_dir):
    batched = batch_table(labelled_messages(spark, sf_dir), "row_id", D.BATCH, keep_tail=False)
    return batched.select("row_id", "row_no", "batch_no", "row_in_batch")


@query
def batch_assign_events(spark, sf_dir):
    """Batches of 1,000 events in order of time: any order key will do."""
    events = load(spark, sf_dir, "events").select("event_id", "ts")
    batched = assign_batches(number_rows_by_range(events, ["ts", "event_id"]), 1000, keep_tail=False)
    return batched.select("event_id", "row_no", "batch_no", "row_in_batch")


@query
def batch_assign_orders(spark, sf_dir):
    return batch_table(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 1024, keep_tail=False).select(
        "o_orderkey", "batch_no", "row_in_batch"
    )


@query
def replay_files_in_order(spark, sf_dir):
    """Documents of one source after those of another; no batch spans two."""
    files = load(spark, sf_dir, "documents").select(
        "doc_id", F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("file_no")
    )
    return replay_files(files, "file_no", "doc_id", 16).select(
        "doc_id", "file_no", "file_batch_no", "batch_no", "row_in_batch"
    )


@query
def replay_epochs_twice(spark, sf_dir):
    labels = load(spark, sf_dir, "labels").select("doc_id")
    return replay_epochs(batch_table(labels, "doc_id", 50, keep_tail=False), 50, 2).select(
        "doc_id", "epoch", "batch_no", "row_in_batch"
    )


@query
def dataset_select(spark, sf_dir):
    """Which of the two files of a dataset each message belongs to."""
    return labelled_messages(spark, sf_dir).select(
        "row_id", F.when(is_test_row(F.col("row_id")), "test").otherwise("train").alias("split")
    )


@query
def batch_sizes(spark, sf_dir):
    rows = D.batched_features(spark, sf_dir, part="both")
    return rows.groupBy("batch_no").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("y")), ",").alias("labels")
    )


# Payloads


@query
def columnar_roundtrip(spark, sf_dir):
    encoded = payloads.encode_columnar(D.batched_messages(spark, sf_dir))
    return payloads.decode_columnar(encoded, keep=["batch_no"])


def _image_rows(spark, sf_dir):
    vectors = load(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda v: F.floor(v.cast("double") * 1000).cast("int")).alias("pixels")
    )
    return batch_table(vectors, "vec_id", 64)


@query
def record_map_roundtrip(spark, sf_dir):
    decoded = payloads.decode_record_map(payloads.encode_record_map(_image_rows(spark, sf_dir)), ["batch_no"])
    return decoded.select("batch_no", "row_in_batch", "label", F.posexplode("pixels").alias("pos", "pixel"))


@query
def nested_map_roundtrip(spark, sf_dir):
    """Vectors as 4 x 4 x 4 images, there and back and flattened."""
    cube = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda j: F.slice("pixels", i * 16 + j * 4 + 1, 4)
    ))
    encoded = payloads.encode_nested_record_map(_image_rows(spark, sf_dir).withColumn("img", cube))
    decoded = payloads.decode_nested_record_map(encoded, ["batch_no"], flatten=True)
    return decoded.select("batch_no", "row_in_batch", "label", F.posexplode("img").alias("pos", "pixel"))


def _image_payloads(spark, sf_dir):
    rows = _image_rows(spark, sf_dir)
    cube = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda j: F.slice("pixels", i * 16 + j * 4 + 1, 4)
    ))
    return payloads.encode_record_map(rows), payloads.encode_nested_record_map(rows.withColumn("img", cube))


@query
def payload_texts(spark, sf_dir):
    """The text of every payload line of each shape, as a digest and its length."""
    flat, nested = _image_payloads(spark, sf_dir)
    numbered = number_rows_by_range(_conversation_lines(spark, sf_dir), ["conv_id", "turn", "line_no"])
    told = None
    for shape, encoded in (
        ("columnar", payloads.encode_columnar(D.batched_messages(spark, sf_dir))), ("record map", flat),
        ("nested record map", nested), ("lines", payloads.encode_lines(assign_batches(numbered, 100))),
    ):
        one = encoded.select(
            F.lit(shape).alias("shape"), "batch_no", F.length("payload").alias("n_chars"), F.md5("payload").alias("digest")
        )
        told = one if told is None else told.unionByName(one)
    return told


def _conversation_lines(spark, sf_dir):
    return load(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


@query
def lines_roundtrip(spark, sf_dir):
    """Lines of all conversations in batches of 100."""
    numbered = number_rows_by_range(_conversation_lines(spark, sf_dir), ["conv_id", "turn", "line_no"])
    encoded = payloads.encode_lines(assign_batches(numbered, 100))
    return payloads.decode_lines(encoded, ["batch_no"])


@query
def text_scan_batches(spark, sf_dir):
    """Benchmark texts written as a line file, read back and cut into batches."""
    path = work_dir(spark, "lines")
    load(spark, sf_dir, "benchmark").select(
        F.explode(F.split("text", "\n")).alias("line")
    ).write.text(path)
    numbered = number_rows_by_range(text_scan(spark, path), ["file", "block_start", "line_key"])
    batches = assign_batches(numbered, 10)
    return batches.groupBy("batch_no").agg(F.count("*").alias("n_lines"))


@query
def csv_scan_rows(spark, sf_dir):
    """Messages written as headed CSV, multi-line fields included, and read back by position."""
    path = work_dir(spark, "csv")
    labelled_messages(spark, sf_dir).select(
        F.col("feature0").alias("Subject"), F.col("feature1").alias("Message"), F.col("feature2").alias("Spam/Ham")
    ).write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return csv_split_scan(spark, path)


# Naive Bayes


@query
def nb_batch_sums(spark, sf_dir):
    """What each batch adds: class sizes (slots 0, 1) and bucket sums per class."""
    return class_sums(D.batched_features(spark, sf_dir)).select("batch_no", "slot", F.round("s", 6).alias("s"))


@query
def nb_model(spark, sf_dir):
    """The model after every batch."""
    table = model_table(D.naive_bayes_models(spark, sf_dir))
    return table.select(
        "batch_no", "y", "bucket", F.round("log_prior", 6).alias("log_prior"),
        F.round("log_likelihood", 6).alias("log_likelihood"),
    )


def nb_train_scored(spark, sf_dir, batch=D.BATCH):
    rows = D.batched_features(spark, sf_dir, batch).select("row_id", "batch_no", "y", "features")
    return score(rows, D.naive_bayes_models(spark, sf_dir, batch), ["batch_no"], broadcast=False)


@query
def nb_predict(spark, sf_dir):
    """Each row under the model of its own batch: log odds and class."""
    return nb_train_scored(spark, sf_dir).select(
        "row_id", "batch_no", "truth", F.round("decision", 6).alias("decision"), "prediction"
    )


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def nb_train_metrics(spark, sf_dir, batch=D.BATCH):
    """Flagship: train on every batch, score the batch just trained on, report."""
    measured = metrics.classification_metrics(nb_train_scored(spark, sf_dir, batch), ["model", "batch_no"])
    return _rounded(measured, "accuracy", "precision", "recall")


# Metrics.  The quality flag stands in for a prediction of the toxic flag.


def _flags(spark, sf_dir):
    flags = load(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("truth"), F.col("quality").alias("prediction"))
    return batch_table(flags, "doc_id", 50)


@query
def accuracy_by_batch(spark, sf_dir):
    measured = metrics.classification_metrics(_flags(spark, sf_dir), ["batch_no"])
    return _rounded(measured, "accuracy").select("batch_no", "n", "accuracy")


@query
def precision_recall(spark, sf_dir):
    measured = metrics.classification_metrics(_flags(spark, sf_dir), ["batch_no"])
    return _rounded(measured, "precision", "recall").select("batch_no", "precision", "recall")


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_flags(spark, sf_dir), ["batch_no"])


DUAL = [f"{m}_spam_{s}" for s in (1, 0) for m in ("accuracy", "precision", "recall")]


@query
def dual_polarity(spark, sf_dir):
    both = metrics.dual_polarity(metrics.confusion_counts(_flags(spark, sf_dir), ["batch_no"]))
    return _rounded(both, *DUAL).select("batch_no", *DUAL)


@query
def error_rate(spark, sf_dir):
    return _rounded(metrics.error_rate(_flags(spark, sf_dir), ["batch_no"]), "error_rate")


@query
def label_flip(spark, sf_dir):
    """Metrics with every prediction inverted."""
    flipped = metrics.invert_predictions(_flags(spark, sf_dir))
    measured = metrics.classification_metrics(flipped, ["batch_no"])
    return _rounded(measured, "accuracy", "precision", "recall")


# Clustering


def _centres(params):
    return [(k, b, float(params[2 + k * H.N_BUCKETS + b])) for k in (0, 1) for b in range(H.N_BUCKETS)]


def _first_batch(spark, sf_dir):
    return D.batched_features(spark, sf_dir).filter(F.col("batch_no") == 1)


def _centre_table(spark, params):
    """Two centres of 512 numbers as rows."""
    return spark.createDataFrame(_centres(params), "cluster int, bucket int, value double").withColumn(
        "value", F.round("value", 6)
    )


@query
def kmeans_init(spark, sf_dir):
    return _centre_table(spark, kmeans.initial_model(_first_batch(spark, sf_dir)))


@query
def kmeans_seeded_init(spark, sf_dir):
    """Centres drawn by squared distance with seed 0."""
    return _centre_table(spark, kmeans.seeded_model(_first_batch(spark, sf_dir), 0))


@query
def kmeans_step(spark, sf_dir):
    """Centres after the first batch."""
    first = _first_batch(spark, sf_dir)
    return _centre_table(spark, kmeans.update(first, kmeans.initial_model(first), 1))


@query
def kmeans_centres(spark, sf_dir):
    """Cluster sizes and centres after every batch."""
    models = D.trained(spark, sf_dir, CLUSTER_FAMILY).models()
    p = F.col("params")
    clusters = F.array(*[
        F.struct(
            F.lit(k).alias("cluster"), F.get(p, F.lit(k)).cast("long").alias("size"),
            slice_of(p, 2 + k * H.N_BUCKETS, H.N_BUCKETS).alias("centre"),
        )
        for k in (0, 1)
    ])
    return models.select("batch_no", F.inline(clusters)).select(
        "batch_no", "cluster", "size", F.posexplode("centre").alias("bucket", "value")
    ).withColumn("value", F.round("value", 6))


@query
def kmeans_assign(spark, sf_dir):
    """Every row with its cluster under the final centres."""
    store = D.trained(spark, sf_dir, CLUSTER_FAMILY)
    rows = D.batched_features(spark, sf_dir).select("row_id", "y", "features")
    scored = score_checkpoints(rows, store.models(), [store.last_batch()])
    return scored.select("row_id", F.col("prediction").alias("cluster"))


@query
def kmeans_stream(spark, sf_dir):
    """The training log of the clusterer under both polarities."""
    log = D.trained(spark, sf_dir, CLUSTER_FAMILY).train_log()
    return _rounded(log, *DUAL).select("batch_no", "n", *DUAL)


# Learners that go row by row


def _weights(spark, sf_dir, model):
    """Weights after every batch; bucket -1 is the intercept."""
    models = D.trained(spark, sf_dir).models(model)
    return models.select("batch_no", F.posexplode("params").alias("pos", "value")).select(
        "batch_no", (F.col("pos") - 1).alias("bucket"), F.round("value", 6).alias("value")
    )


@query
def logreg_weights(spark, sf_dir):
    return _weights(spark, sf_dir, LOGISTIC)


@query
def perceptron_weights(spark, sf_dir):
    return _weights(spark, sf_dir, PERCEPTRON)


@query
def mlp_weights(spark, sf_dir):
    """Parameters of the network after every batch, by position."""
    models = D.trained(spark, sf_dir).models(MLP)
    return models.select("batch_no", F.posexplode("params").alias("pos", "value")).withColumn(
        "value", F.round("value", 6)
    )


@query
def logreg_predict(spark, sf_dir):
    return _predictions(spark, sf_dir, LOGISTIC)


@query
def perceptron_predict(spark, sf_dir):
    return _predictions(spark, sf_dir, PERCEPTRON)


@query
def mlp_predict(spark, sf_dir):
    """Every held-out row scored by every checkpoint of the network."""
    scored = D.every_checkpoint(spark, sf_dir, CLASSIFIER_FAMILY, MLP)
    return scored.select("row_id", "checkpoint", "truth", "prediction")


def _predictions(spark, sf_dir, model):
    """Every held-out row scored by every tenth checkpoint of one model and the last."""
    scored = D.checkpoint_predictions(spark, sf_dir, CLASSIFIER_FAMILY, model=model)
    return scored.select("row_id", "checkpoint", "truth", "prediction")


@query
def sharded_fit(spark, sf_dir):
    """All labelled rows as one batch, learnt in eight shards whose weights are averaged."""
    rows = D.batched_features(spark, sf_dir, 1, "both").withColumn("row_in_batch", F.col("row_no"))
    n = rows.count()
    fitted = fit_batch(rows, {m: initial_state(m) for m in (LOGISTIC, PERCEPTRON, MLP)}, shards=8)
    weights = spark.createDataFrame(
        [(m, n, s.params.tolist()) for m, s in fitted.items()], "model string, n long, params array<double>"
    )
    return weights.select("model", "n", F.posexplode("params").alias("pos", "value")).withColumn(
        "value", F.round("value", 6)
    )


# Streams


@query
def stream_decode(spark, sf_dir):
    """The log of payloads as a stream."""
    out = work_dir(spark, "decoded")
    Replay(payload_stream(spark, D.payload_folder(spark, sf_dir, part="both"), batches_per_trigger=1024)
           .writeStream.format("parquet").option("path", out)
           .option("checkpointLocation", work_dir(spark, "progress")).start()).awaitTermination()
    return spark.read.parquet(out).select("batch_no", "row_in_batch", "feature0", "feature1", "feature2")


def _classifier_log(spark, sf_dir):
    return D.trained(spark, sf_dir).train_log()


@query
def stream_train_log(spark, sf_dir):
    """Training log of the classifiers."""
    log = _classifier_log(spark, sf_dir)
    return _rounded(log, "accuracy", "precision", "recall").drop("epoch_id")


@query
def mlp_stream(spark, sf_dir):
    log = _classifier_log(spark, sf_dir).filter(F.col("model") == MLP)
    return _rounded(log, "accuracy", "precision", "recall").drop("epoch_id")


@query
def stream_test_log(spark, sf_dir):
    """Predictions of the final models over the stream of held-out messages."""
    log = D.tested(spark, sf_dir).test_log()
    return log.select("model", "batch_no", "row_in_batch", "prediction", "truth")


@query
def cluster_test_log(spark, sf_dir):
    log = D.tested(spark, sf_dir, CLUSTER_FAMILY).test_log()
    return log.select("model", "batch_no", "row_in_batch", "prediction", "truth")


@query
def model_latest(spark, sf_dir):
    """The final models: their number and the size of their parameters."""
    return D.trained(spark, sf_dir).load_models().select(
        "model", "batch_no", F.size("params").alias("n_params")
    )


@query
def model_number(spark, sf_dir):
    """Held-out predictions of models loaded by number: after batch 1, saved whole, and
    after batch 2, saved as what it changed."""
    store = D.trained(spark, sf_dir)
    rows = D.batched_features(spark, sf_dir, part="test").select("row_id", "y", "features")
    scored = None
    for number in (1, 2):
        models = store.load_models(number).select("model", F.col("batch_no").alias("checkpoint"), "params")
        one = score(rows.withColumn("checkpoint", F.lit(number).cast("long")), models, ["checkpoint"])
        scored = one if scored is None else scored.unionByName(one)
    return scored.select("model", "checkpoint", "row_id", "prediction", "truth")


@query
def test_after_reset(spark, sf_dir):
    """A run that trains, clears its logs and is tested: the final model still scores."""
    store = Store(spark, work_dir(spark, "reset"))
    store.create()
    stream_train(spark, D.payload_folder(spark, sf_dir), store.root, models=(NAIVE_BAYES,)).awaitTermination()
    store.reset_logs()
    stream_test(spark, D.payload_folder(spark, sf_dir, part="test"), store.root).awaitTermination()
    return store.test_log().select("model", "batch_no", "row_in_batch", "prediction", "truth")


def _naive_bayes_log(spark, store, rows):
    """Rows cut into batches, sent as payloads and learnt: the log of the run."""
    path = work_dir(spark, "payloads")
    write_payloads(payloads.encode_columnar(batch_table(rows, "row_id", D.BATCH)), path)
    stream_train(spark, path, store.root, models=(NAIVE_BAYES,)).awaitTermination()
    return _rounded(store.train_log(), "accuracy", "precision", "recall").drop("epoch_id")


@query
def csv_to_log(spark, sf_dir):
    """Training messages from a headed CSV file all the way to the training log."""
    path = work_dir(spark, "csv")
    D.messages(spark, sf_dir, "train").orderBy("row_id").select(
        F.col("feature0").alias("Subject"), F.col("feature1").alias("Message"), F.col("feature2").alias("Spam/Ham")
    ).write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    store = Store(spark, work_dir(spark, "run"))
    store.create()
    return _naive_bayes_log(spark, store, csv_rows(spark, path))


@query
def plain_stream_log(spark, sf_dir):
    """Training on a folder of plain payload lines, which say no batch number."""
    path = work_dir(spark, "plain")
    write_plain(payloads.encode_columnar(D.batched_messages(spark, sf_dir, part="train")), path)
    store = Store(spark, work_dir(spark, "run"))
    store.create()
    stream_train(spark, path, store.root, plain=True, models=(NAIVE_BAYES,)).awaitTermination()
    return _rounded(store.train_log(), "accuracy", "precision", "recall").drop("epoch_id")


@query
def nb_state_log(spark, sf_dir):
    """Naive Bayes trained as a stream whose sums are in Spark's state store."""
    store = Store(spark, work_dir(spark, "bayes"))
    store.create()
    stream_bayes(spark, D.payload_folder(spark, sf_dir), store.root).awaitTermination()
    return _rounded(store.train_log(), "accuracy", "precision", "recall").drop("epoch_id")


@query
def replay_epochs_stream(spark, sf_dir):
    """The stream of a log that is replayed twice, batch numbers counted on."""
    labels = load(spark, sf_dir, "labels").select("doc_id")
    batched = batch_table(labels, "doc_id", 50, keep_tail=False).withColumn("line", F.col("doc_id").cast("string"))
    path, out = work_dir(spark, "replayed"), work_dir(spark, "decoded")
    write_log(payloads.encode_lines(batched), path)
    lines = payloads.decode_lines(stream_log(spark, path, batches_per_trigger=64, epochs=2), ["batch_no"])
    Replay(lines.writeStream.format("parquet").option("path", out)
           .option("checkpointLocation", work_dir(spark, "progress")).start()).awaitTermination()
    n_batches = read_log(spark, path).agg(F.max("batch_no")).first()[0] or 1
    return spark.read.parquet(out).select(
        F.rtrim(F.regexp_replace("line", "\n", "")).cast("long").alias("doc_id"),
        F.expr(f"(batch_no - 1) div {n_batches}").cast("int").alias("epoch"), "batch_no", F.col("pos").alias("row_in_batch"),
    )


@query
def stream_progress(spark, sf_dir):
    """A run at an interval whose last micro-batch is an empty batch: it is started,
    takes in all rows, leaves no log row or commit for the empty one, and is ended."""
    per_trigger = BATCHES_PER_TRIGGER
    sent = payloads.encode_columnar(D.batched_messages(spark, sf_dir, part="train"))
    n_batches = sent.agg(F.max("batch_no")).first()[0] or 0
    alone = (n_batches // per_trigger + 1) * per_trigger + 1  # the first of a micro-batch of its own
    nothing = spark.createDataFrame([(alone, '{"feature0":[],"feature1":[],"feature2":[]}')], sent.select("batch_no", "payload").schema)
    path, store = work_dir(spark, "payloads"), Store(spark, work_dir(spark, "run"))
    write_payloads(sent.select("batch_no", "payload").unionByName(nothing), path)
    store.create()
    with Progress(spark) as progress:
        query = stream_train(
            spark, path, store.root, delay=1, batches_per_trigger=per_trigger, models=(NAIVE_BAYES,), observe=True
        )
        query.processAllAvailable()
        query.stop()
    events = progress.table()
    told = events.filter("event = 'progress'").agg(F.sum("rows").alias("n")).select(F.lit("rows").alias("what"), "n")
    for what, n in (
        ("started", events.filter("event = 'started'")), ("terminated", events.filter("event = 'terminated'")),
        ("logged", store.train_log()), ("models", store.models()),
    ):
        told = told.unionByName(n.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n"))
    return told


@query
def log_reset(spark, sf_dir):
    """A run that trains, then clears its logs: models stay, logs are empty."""
    store = Store(spark, work_dir(spark, "reset"))
    store.create()
    stream_train(spark, D.payload_folder(spark, sf_dir), store.root, models=(NAIVE_BAYES,)).awaitTermination()
    store.reset_logs()
    tables = {"models": store.models(), "train_log": store.train_log(), "test_log": store.test_log()}
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count("*").alias("n")).select(F.lit(name).alias("log"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


# Reports


@query
def batch_report(spark, sf_dir):
    return metrics.batch_report(_classifier_log(spark, sf_dir))


@query
def cluster_report(spark, sf_dir):
    """The clusterer's report of every batch under both polarities."""
    return metrics.cluster_report(D.trained(spark, sf_dir, CLUSTER_FAMILY).train_log())


@query
def report_metric_curves(spark, sf_dir):
    """Report mode 3: all supervised models on one batch axis, metric by metric."""
    log = _classifier_log(spark, sf_dir)
    return _rounded(reports.report(reports.METRIC_CURVES, train_log=log), *CLASSIFIERS)


@query
def train_curve_long(spark, sf_dir):
    log = _classifier_log(spark, sf_dir)
    return _rounded(reports.report(reports.MODEL_CURVES, train_log=log), "value")


@query
def train_curve_one_model(spark, sf_dir):
    return _rounded(reports.curve_of_model(_classifier_log(spark, sf_dir), PERCEPTRON), "value")


@query
def train_curve_pivot(spark, sf_dir):
    log = _classifier_log(spark, sf_dir)
    return _rounded(reports.curves_of_all_models(log, list(CLASSIFIERS)), *CLASSIFIERS)


@query
def test_accuracy_bar(spark, sf_dir):
    log = D.tested(spark, sf_dir).test_log()
    return _rounded(reports.report(reports.TEST_ACCURACY, test_log=log), "accuracy")


@query
def test_curve(spark, sf_dir):
    """Test metrics of the classifiers by checkpoint, all but the final one."""
    return _rounded(reports.curve_of_counts(D.tested_counts(spark, sf_dir, CLASSIFIER_FAMILY)), "value")


@query
def test_curve_clustering(spark, sf_dir):
    """Test metrics of the clusterer by checkpoint under both polarities, the final one included."""
    counts = D.tested_counts(spark, sf_dir, CLUSTER_FAMILY)
    return _rounded(reports.curve_of_counts(counts, include_final=True), "value")


@query
def mlp_test_curve(spark, sf_dir):
    counts = D.tested_counts(spark, sf_dir, CLASSIFIER_FAMILY).filter(F.col("model") == MLP)
    return _rounded(reports.curve_of_counts(counts, include_final=True), "value")


@query
def test_curve_order(spark, sf_dir):
    """Points of the clusterer's test curves, numbered in order of their checkpoints."""
    counts = D.tested_counts(spark, sf_dir, CLUSTER_FAMILY)
    return _rounded(reports.numbered_curve(reports.curve_of_counts(counts, include_final=True)), "value")


@query
def preview_test_log(spark, sf_dir):
    """The first five records of the test log."""
    log = D.tested(spark, sf_dir).test_log().select("model", "batch_no", "row_in_batch", "prediction", "truth")
    return reports.preview(log, "model", "batch_no", "row_in_batch")


@query
def preview5(spark, sf_dir):
    log = _classifier_log(spark, sf_dir).filter(F.col("model") == PERCEPTRON)
    return _rounded(reports.preview(log.select("model", "batch_no", "accuracy"), "batch_no"), "accuracy")


def _exported(spark, sf_dir, every=False):
    """Logs of the runs as CSV files in folders per model, and the last batch's number; the
    clusterer's test logs are of its first two checkpoints or of ``every`` one, and the final one."""
    def build():
        root = work_dir(spark, "logs")
        store = D.tested(spark, sf_dir)
        clusters = D.tested(spark, sf_dir, CLUSTER_FAMILY)
        if every:
            numbered = D.every_checkpoint(spark, sf_dir, CLUSTER_FAMILY, CLUSTERING)
            numbered = numbered.filter(F.col("checkpoint") != clusters.last_batch())
        else:
            numbered = D.checkpoint_predictions(spark, sf_dir, CLUSTER_FAMILY, checkpoints=[1, 2])
        logs.export_csv_logs(
            root, store.train_log(), clusters.train_log(), store.test_log().select("model", "checkpoint", *logs.TEST_HEADER)
        )
        logs.export_csv_logs(root, test=(
            clusters.test_log().select("model", "checkpoint", *logs.TEST_HEADER)
            .unionByName(numbered.select("model", "checkpoint", *logs.TEST_HEADER))
        ))
        return root, store.last_batch()

    return D._once(spark, f"exported-{every}", sf_dir, D.BATCH, build)


@query
def csv_train_logs(spark, sf_dir):
    """CSV training logs found by folder name and read back."""
    root, _ = _exported(spark, sf_dir)
    read = logs.read_train_logs(spark, root, CLASSIFIERS)
    return _rounded(read, "accuracy", "precision", "recall").withColumn("batch_no", F.col("batch_no").cast("long"))


@query
def csv_cluster_log(spark, sf_dir):
    root, _ = _exported(spark, sf_dir)
    read = _rounded(logs.read_cluster_log(spark, root), *DUAL)
    return read.select(F.col("batch_no").cast("long").alias("batch_no"), *DUAL)


@query
def checkpoint_number(spark, sf_dir):
    """Test logs by the checkpoint their file is named after: records and hits."""
    root, last = _exported(spark, sf_dir, every=True)
    read = logs.read_test_logs(spark, root, last)
    return read.groupBy("model", "checkpoint", "is_final").agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("truth")).alias("hits")
    )

"""Registered queries against their SQL, by value."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import MEDIUM

QUICK = [
    "concat_joint", "label_encode", "clean_steps", "page_clean", "tokenize", "porter_stem", "preprocess", "hash_bucket",
    "l2_features", "batch_assign", "batch_assign_events", "replay_files_in_order", "replay_epochs_twice",
    "columnar_roundtrip", "record_map_roundtrip", "lines_roundtrip", "nb_model", "nb_predict", "nb_train_metrics",
    "dual_polarity", "kmeans_step", "kmeans_stream", "logreg_weights", "stream_train_log", "stream_test_log",
    "train_curve_pivot", "test_curve_clustering", "checkpoint_number", "model_number", "test_after_reset", "csv_to_log",
    "plain_stream_log", "sharded_fit", "mlp_test_curve", "test_curve", "test_accuracy_bar", "stream_decode",
]


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{MEDIUM}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sql, name):
    made = entry.queries()[name](spark, MEDIUM)
    result = sql.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(made.columns) == sorted(columns)
    expected = rows(columns, result.fetchall())
    assert expected and rows(made.columns, made.collect()) == expected


def test_predictions_and_logs_are_of_every_checkpoint(spark, sql):
    """Of the network row by row, and of the clusterer by file: more than two checkpoints here."""
    made = entry.queries()["mlp_predict"](spark, MEDIUM)
    result = sql.execute(entry.oracle_sql()["mlp_predict"])
    columns = [c[0] for c in result.description]
    assert rows(made.columns, made.collect()) == rows(columns, result.fetchall())
    n_batches = sql.execute(f"SELECT max(batch_no) FROM ({entry.oracle_sql()['stream_train_log']})").fetchone()[0]
    everyone = list(range(1, n_batches + 1))
    assert n_batches > 3 and sorted(r.checkpoint for r in made.select("checkpoint").distinct().collect()) == everyone
    logs = entry.queries()["checkpoint_number"](spark, MEDIUM).filter("model = 'Clustering'").collect()
    assert sorted(r.checkpoint for r in logs) == everyone


def test_every_statement_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    made = entry.entry(spark)
    assert [r.batch_no for r in made.orderBy("batch_no").collect()] == [1, 2, 3, 4]

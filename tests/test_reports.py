import pytest
from pyspark.sql import functions as F

from sieveline.operators import reports
from sieveline.operators.metrics import batch_report
from sieveline.operators.models import CLUSTERING, LOGISTIC, NAIVE_BAYES, PERCEPTRON
from sieveline.session import work_dir
from sieveline.sources import logs


@pytest.fixture
def folder(tmp_path):
    """Two classifiers, the clusterer and a folder that is no model."""
    for model in (NAIVE_BAYES, PERCEPTRON, "Notes"):
        train = tmp_path / model / "TrainLogs"
        train.mkdir(parents=True)
        (train / "logs.csv").write_text("BatchNum,Accuracy,Precision,Recall\n1,0.5,0.25,1.0\n2,0.75,0.5,0.5\n")
    clusters = tmp_path / CLUSTERING / "TrainLogs"
    clusters.mkdir(parents=True)
    (clusters / "logs.csv").write_text(
        "batchNum,accuracy_spam_1,precision_spam_1,recall_spam_1,accuracy_spam_0,precision_spam_0,recall_spam_0\n"
        "1,0.1,0.2,0.3,0.9,0.8,0.7\n"
    )
    for name, lines in {"logs.csv": "1,1,1\n1,0,1\n", "logs20.csv": "1,1,1\n", "logs100.csv": "1,0,1\n1,0,0\n2,1,0\n"}.items():
        for model in (NAIVE_BAYES, CLUSTERING):
            test = tmp_path / model / "TestLogs"
            test.mkdir(parents=True, exist_ok=True)
            (test / name).write_text("BatchNum,Prediction,GroundTruth\n" + lines)
    return str(tmp_path)


def test_training_logs_by_folder(spark, folder):
    read = logs.read_train_logs(spark, folder, [NAIVE_BAYES, PERCEPTRON, LOGISTIC])
    assert sorted((r.model, r.batch_no, r.accuracy) for r in read.collect()) == [
        (NAIVE_BAYES, 1, 0.5), (NAIVE_BAYES, 2, 0.75), (PERCEPTRON, 1, 0.5), (PERCEPTRON, 2, 0.75),
    ]
    assert logs.read_cluster_log(spark, folder).first().recall_spam_0 == 0.7


def test_checkpoint_numbers(spark, folder):
    read = logs.read_test_logs(spark, folder, last=303)
    counts = {(r.model, r.checkpoint, r.is_final): r.n for r in read.groupBy("model", "checkpoint", "is_final").agg(F.count("*").alias("n")).collect()}
    assert counts == {(m, c, c == 303): n for m in (NAIVE_BAYES, CLUSTERING) for c, n in ((303, 2), (20, 1), (100, 3))}


def test_test_curve(spark, folder):
    read = logs.read_test_logs(spark, folder, last=303)
    curve = {(r.metric, r.model, r.polarity, r.checkpoint): r.value for r in reports.test_curve(read).collect()}
    assert {k[3] for k in curve} == {20, 100}
    assert curve["accuracy", NAIVE_BAYES, 1, 100] == pytest.approx(1 / 3)
    assert curve["accuracy", CLUSTERING, 0, 100] == pytest.approx(2 / 3)
    assert ("accuracy", NAIVE_BAYES, 0, 100) not in curve
    with_final = reports.test_curve(read, include_final=True)
    assert {r.checkpoint for r in with_final.collect()} == {20, 100, 303}
    ordered = [r.checkpoint for r in reports.in_curve_order(with_final).collect()]
    assert ordered[:3] == [20, 100, 303]


def test_curves(spark, folder):
    train = logs.read_train_logs(spark, folder, [NAIVE_BAYES, PERCEPTRON])
    extra = spark.createDataFrame([(3, 0.9, 0.9, 0.9, NAIVE_BAYES)], train.schema)
    wide = reports.report(3, train_log=train.unionByName(extra))
    by = {(r.metric, r.batch_no): r for r in wide.collect()}
    assert by["accuracy", 2][NAIVE_BAYES] == by["accuracy", 2][PERCEPTRON] == 0.75
    assert by["recall", 3][NAIVE_BAYES] == 0.9 and by["recall", 3][PERCEPTRON] is None
    assert reports.report(2, train_log=train).count() == 12
    assert reports.curve_of_model(train, PERCEPTRON).count() == 6
    assert [r.batch_no for r in reports.preview(train.filter(F.col("model") == PERCEPTRON), "batch_no").collect()] == [1, 2]


def test_bars_leave_the_clusterer_out(spark, folder):
    read = logs.read_test_logs(spark, folder, last=303).filter("checkpoint = 100")
    bars = reports.report(1, test_log=read).collect()
    assert [(r.model, r.bar_label) for r in bars] == [(NAIVE_BAYES, 0.333)]
    with pytest.raises(ValueError):
        reports.report(4)


def test_written_logs_read_back(spark, folder):
    root = work_dir(spark, "exported")
    train = logs.read_train_logs(spark, folder, [NAIVE_BAYES, PERCEPTRON])
    test = spark.createDataFrame(
        [(NAIVE_BAYES, 0, 1, 1, 0), (NAIVE_BAYES, 20, 1, 0, 0)],
        "model string, checkpoint int, batch_no int, prediction int, truth int",
    )
    logs.export_csv_logs(root, train, logs.read_cluster_log(spark, folder), test)
    again = logs.read_train_logs(spark, root, [NAIVE_BAYES, PERCEPTRON])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, train.collect()))
    assert logs.read_cluster_log(spark, root).count() == 1
    back = {(r.checkpoint, r.is_final, r.prediction) for r in logs.read_test_logs(spark, root, last=7).collect()}
    assert back == {(7, True, 1), (20, False, 0)}


def test_many_test_logs_are_written_in_one_pass(spark, tmp_path, monkeypatch):
    """No write for every log; what stood in the place of a log is gone, and nothing else is left over."""
    root, names = str(tmp_path), ("Odd = name, 50%", NAIVE_BAYES)
    rows = [(m, c, b, (b + c) % 2, b % 2) for m in names for c in range(30) for b in (1, 1, 2, 1500)]
    test = spark.createDataFrame(rows + [(None, 3, 1, 0, 0)], "model string, checkpoint long, batch_no long, prediction int, truth int")
    monkeypatch.setattr(logs, "write_csv_log", lambda *_: pytest.fail("a write for one log"))
    logs.export_csv_logs(root, test=spark.createDataFrame([(NAIVE_BAYES, 7, 9, 9, 9)], test.schema))
    logs.export_csv_logs(root, test=test)
    read = logs.read_test_logs(spark, root, last=99, models=names)
    assert sorted((r.model, r.checkpoint, r.batch_no, r.prediction, r.truth) for r in read.collect()) == sorted(
        (m, c or 99, *rest) for m, c, *rest in rows
    )
    assert {r.checkpoint for r in read.filter("is_final").collect()} == {99}
    assert {p.name for p in tmp_path.iterdir()} == set(names)
    logs.export_csv_logs(root, test=test.limit(0))
    assert read.count() == len(rows)


def test_file_names_are_not_taken_apart_for_every_line(spark, folder):
    plan = logs.read_test_logs(spark, folder, last=303)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below_join = next(i for i, line in enumerate(plan) if "Join" in line)
    scanned = next(i for i, line in enumerate(plan) if line.rstrip().endswith("csv"))
    assert scanned > below_join
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    own = [line for line in plan[below_join + 1:scanned] if depth(line) <= depth(plan[scanned])]
    assert not [line for line in plan[:below_join] + own if "regexp" in line.lower() or "rlike" in line.lower()]


def test_batch_report(spark):
    counts = spark.createDataFrame(
        [(PERCEPTRON, 1, 4, 1, 1, 0, 2, 0.75, 0.5, 1.0)],
        "model string, batch_no int, n long, tp long, fp long, fn long, tn long, accuracy double, precision double, recall double",
    )
    r = batch_report(counts).first()
    assert (r.batch_size, r.accuracy, r.precision, r.recall, r.confusion_matrix) == (4, "0.750", "0.500", "1.000", "[[2 1] [0 1]]")

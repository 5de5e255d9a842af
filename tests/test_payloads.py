import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from sieveline.operators import payloads as P
from sieveline.operators.batching import assign_batches, batch_table, number_rows_by_range
from sieveline.sources import csv_records as R
from sieveline.sources.tables import csv_rows, csv_scan, dataset_split, text_scan


def test_columnar_payload_shape(spark):
    rows = spark.createDataFrame(
        [(0, "hi", "see you", "ham"), (1, "win", "free \"money\"\n", "spam")],
        "k long, feature0 string, feature1 string, feature2 string",
    )
    encoded = P.encode_columnar(batch_table(rows, "k", 2)).collect()
    assert len(encoded) == 1
    assert json.loads(encoded[0].payload) == {
        "first_row": 0, "feature0": ["hi", "win"], "feature1": ["see you", "free \"money\"\n"], "feature2": ["ham", "spam"],
    }


def test_columnar_payload_without_position(spark):
    text = '{"feature0":["hi","win"],"feature1":["see you","free money"],"feature2":["ham","spam"]}'
    rows = P.decode_columnar(spark.createDataFrame([(text,)], "payload string")).collect()
    assert [tuple(r) for r in rows] == [(0, "hi", "see you", "ham"), (1, "win", "free money", "spam")]


def test_ragged_arrays_are_padded(spark):
    text = '{"feature0":["a","b"],"feature1":["c"],"feature2":[]}'
    rows = P.decode_columnar(spark.createDataFrame([(text,)], "payload string")).collect()
    assert [tuple(r) for r in rows] == [(0, "a", "c", None), (1, "b", None, None)]


def test_nulls_survive(spark):
    rows = spark.createDataFrame(
        [(i, None if i % 2 else "s", str(i), None) for i in range(4)],
        "k long, feature0 string, feature1 string, feature2 string",
    )
    decoded = P.decode_columnar(P.encode_columnar(batch_table(rows, "k", 4)), keep=["batch_no"]).collect()
    assert sorted((r.row_in_batch, r.feature0, r.feature1, r.feature2) for r in decoded) == [
        (i, None if i % 2 else "s", str(i), None) for i in range(4)
    ]


def test_large_batches_take_several_lines(spark, monkeypatch):
    monkeypatch.setattr(P, "LINE_ROWS", 7)
    rows = spark.range(40).select(F.col("id").alias("k"), *[F.concat(F.lit(c), F.col("id")).alias(c) for c in P.FEATURES])
    encoded = P.encode_columnar(batch_table(rows, "k", 20))
    assert encoded.count() == 6
    decoded = P.decode_columnar(encoded, keep=["batch_no"]).collect()
    assert sorted(((r.batch_no - 1) * 20 + r.row_in_batch, r.feature1) for r in decoded) == [
        (i, f"feature1{i}") for i in range(40)
    ]


def test_record_map(spark):
    rows = spark.createDataFrame([(0, [1, 2], 6), (1, [3, 4], 9)], "k long, pixels array<int>, label int")
    encoded = P.encode_record_map(batch_table(rows, "k", 2))
    assert json.loads(encoded.first().payload) == {
        "0": {"feature0": 1, "feature1": 2, "label": 6}, "1": {"feature0": 3, "feature1": 4, "label": 9},
    }
    decoded = P.decode_record_map(encoded).collect()
    assert sorted((r.row_in_batch, r.pixels, r.label) for r in decoded) == [(0, [1, 2], 6), (1, [3, 4], 9)]


def test_pixels_are_ordered_by_number(spark):
    pixels = list(range(100, 112))
    rows = spark.createDataFrame([(0, pixels, 1)], "k long, pixels array<int>, label int")
    assert P.decode_record_map(P.encode_record_map(batch_table(rows, "k", 1))).first().pixels == pixels


def test_pixels_with_gaps_and_other_names(spark):
    """Missing numbers are null, numbers beyond the count and other names are no pixels."""
    payload = json.dumps({
        "0": {"feature0": 5, "feature2": 7, "label": 1}, "1": {"feature3": 1, "feature1": 2, "feature12": 9, "label": 0},
        "2": {"label": 3}, "3": {"featurex": 4, "feature0": 6},
    })
    df = spark.createDataFrame([(payload,)], "payload string")
    made = {r.row_in_batch: (r.pixels, r.label) for r in P.decode_record_map(df).collect()}
    assert made == {0: ([5, None], 1), 1: ([None, 2, None], 0), 2: ([], 3), 3: ([6, None], None)}


def test_nested_record_map(spark):
    img = [[[1, 2], [3, 4]]]
    rows = spark.createDataFrame([(0, img, 0)], "k long, img array<array<array<int>>>, label int")
    encoded = P.encode_nested_record_map(batch_table(rows, "k", 1))
    assert json.loads(encoded.first().payload) == {"0": {"img": img, "label": 0}}
    assert P.decode_nested_record_map(encoded).first().img == img
    assert P.decode_nested_record_map(encoded, flatten=True).first().img == [1, 2, 3, 4]


def test_lines_keep_their_newline(spark):
    rows = spark.createDataFrame([(0, "first line"), (1, "second line")], "k long, line string")
    encoded = P.encode_lines(batch_table(rows, "k", 2))
    assert json.loads(encoded.first().payload) == ["first line\n", "second line\n"]
    assert [tuple(r) for r in P.decode_lines(encoded).collect()] == [(0, "first line\n"), (1, "second line\n")]


def test_csv_by_position(spark, tmp_path):
    (tmp_path / "mail.csv").write_text('Subject,Message,Spam/Ham\nhi,"two\nlines, ""quoted""",ham\n,empty subject,spam\n')
    rows = [tuple(r) for r in csv_scan(spark, str(tmp_path / "mail.csv")).collect()]
    assert rows == [("hi", 'two\nlines, "quoted"', "ham"), (None, "empty subject", "spam")]
    assert csv_scan(spark, str(tmp_path / "mail.csv")).columns == list(P.FEATURES)


@pytest.mark.parametrize("block, buckets", [("37", 50_000), ("400", 50_000), ("100000", 50_000), ("61", 2)])
def test_csv_blocks_at_any_place(spark, monkeypatch, tmp_path, block, buckets):
    """Quotes, line ends and empty fields on both sides of every block edge, as the csv module reads them."""
    monkeypatch.setattr(R, "MAX_BUCKETS", buckets)
    rng = random.Random(int(block))
    pieces = ["a", "", '"', '""', ",", "\n", "\r\n", " ", "é", "\n\n", 'x"y', "word " * 9]
    expected = []
    for f in range(3):
        rows = [["".join(rng.choice(pieces) for _ in range(rng.randrange(5))) + "." for _ in range(3)] for _ in range(60 * f)]
        with open(tmp_path / f"part{f}.csv", "w", newline="") as out:
            writer = csv.writer(out, quoting=csv.QUOTE_ALL if f == 1 else csv.QUOTE_MINIMAL, lineterminator="\r\n" if f == 2 else "\n")
            writer.writerow(["Sub\nject", "Message", "Spam/Ham"])
            for i, row in enumerate(rows):
                writer.writerow(row)
                if i % 7 == 0:
                    out.write("\r\n" if f == 2 else "\n")  # an empty line is no record
        expected += rows
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        assert block == "100000" or R._lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 3
        got = csv_rows(spark, str(tmp_path)).orderBy("row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert [r.row_id for r in got] == list(range(len(expected)))
    assert [[r.feature0, r.feature1, r.feature2] for r in got] == expected


def test_text_lines_keep_their_order(spark, tmp_path):
    lines = [f"line {i}" for i in range(1000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        numbered = number_rows_by_range(text_scan(spark, str(tmp_path / "a.txt")), ["file", "block_start", "line_key"])
        made = assign_batches(numbered, 100).orderBy("batch_no", "row_in_batch").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in made] == lines


def test_split_modes(spark):
    rows = spark.range(10).toDF("row_id")
    train, test = dataset_split(rows, "train"), dataset_split(rows, "test")
    assert sorted(r[0] for r in test.collect()) == [0, 5] and train.count() == 8
    try:
        dataset_split(rows, "both")
    except ValueError:
        pass
    else:
        raise AssertionError("an unknown mode must be refused")

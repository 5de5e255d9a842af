import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from porter_check import stem
from sieveline.functions import text as T
from sieveline.functions import vectors
from sieveline.functions.hashing import md5_bucket, murmur3, murmur3_bucket, spark_bucket
from sieveline.functions.porter import stem_tokens
from sieveline.functions.vectors import bucket_counts, dot, hash_buckets, l2_normalize, sparse_vector, to_dense
from sieveline.operators.features import FeatureOptions, featurize


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(make(F.col("t"))).first()[0]


# Examples printed in the paper, taken through all steps.
PAPER = {
    "caresses": "caress", "ponies": "poni", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "relational": "relat", "conditional": "condit", "valenci": "valenc",
    "digitizer": "digit", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
    "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "communism": "commun", "activate": "activ", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll",
}
# Rules beyond the paper.
EXTENDED = {
    "dies": "die", "flies": "fli", "died": "die", "spied": "spi", "skies": "sky", "dying": "die", "news": "news",
    "is": "is", "as": "as", "enjoy": "enjoy", "spy": "spi", "by": "by", "theologi": "theolog", "geologi": "geolog",
    "archaeologi": "archaeolog", "fully": "fulli", "artfulli": "art", "proceed": "proceed",
}


def stems(spark, words):
    rows = spark.createDataFrame([(list(words),)], "w array<string>")
    return dict(zip(words, rows.select(stem_tokens(F.col("w"))).first()[0]))


def test_stems_of_the_paper(spark):
    assert stems(spark, list(PAPER)) == PAPER


def test_extended_rules(spark):
    assert stems(spark, list(EXTENDED)) == EXTENDED


def test_stems_of_a_whole_vocabulary(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    words = [r[0] for r in documents.select(F.explode(T.tokenize(T.clean_text(F.col("text"))))).distinct().collect()]
    made = [a + b for a in ("y", "ay", "by", "st", "ab", "oy", "x") for b in (
        "yying", "yyed", "ally", "alli", "fulli", "logi", "eed", "ied", "ies", "ing", "ation", "tion", "ion", "ement",
        "ll", "lly", "yyy", "ayed", "tting", "bbed", "ssed", "zzing", "ating", "izing", "iviti", "biliti", "ness")]
    words = sorted(set(words + made))
    assert len(words) > 10_000
    assert stems(spark, words) == {w: stem(w) for w in words}


@pytest.mark.parametrize("text, cleaned", [
    ("Hello, World!", "hello world "),
    ("a\r\nb", "a b"), ("a\nb", "a b"), ("a\\r\\nb", "a b"), ("a\\rb", "a rb"),
    ("1234 !!", " "), ("éclair naïve", " clair na ve"), ("", ""), ("A  B\t\tC", "a b c"),
])
def test_clean(spark, text, cleaned):
    assert one(spark, text, T.clean_text) == cleaned
    step_by_step = lambda t: T.collapse_spaces(T.strip_non_alpha(T.strip_escaped_crlf(F.lower(t))))
    assert one(spark, text, step_by_step) == cleaned


def test_clean_survives_long_runs(spark):
    assert one(spark, "a" + "-" * 200_000 + "b", T.clean_text) == "a b"


def test_stop_words_are_tested_before_stemming(spark):
    assert one(spark, "Don't be having the cats", T.preprocess) == "cat"
    assert len(T.STOP_WORDS) == len(set(T.STOP_WORDS))
    # 'doings' is no stop word although its stem is.
    assert one(spark, "doings", T.preprocess) == "do"


def test_stop_words_can_be_replaced(spark):
    assert one(spark, "the cats", lambda t: T.preprocess(t, stop_words=["cats"])) == "the"
    assert one(spark, "the cats", lambda t: T.preprocess(t, stop_words=[])) == "the cat"


def test_printed_row_form(spark):
    assert one(spark, "win\nmoney", lambda t: T.preprocess(t, repr_compat=True)) == "row joint win nmoney"
    assert one(spark, "win\r\nmoney", lambda t: T.preprocess(t, repr_compat=True)) == "row joint win money"
    assert one(spark, None, lambda t: T.preprocess(t, repr_compat=True)) == "row joint none"


def test_null_sides(spark):
    row = spark.createDataFrame([(None, "m")], "s string, m string")
    s, m = F.col("s"), F.col("m")
    assert row.select(T.join_subject_message(s, m)).first()[0] == " m"
    assert row.select(T.join_subject_message(s, m, "nan")).first()[0] == "nan m"
    assert row.select(T.join_subject_message(s, m, None)).first()[0] is None


@pytest.mark.parametrize("label, y", [("spam", 1), ("ham", 0), ("Spam", 0), ("spam ", 0), (None, 0)])
def test_label(spark, label, y):
    assert one(spark, label, T.encode_label) == y


@pytest.mark.parametrize("value, cut", [(0.9999, 0.999), (0.5, 0.5), (-0.9999, -0.999), (1.0, 1.0), (0.0, 0.0)])
def test_truncate3(spark, value, cut):
    assert one(spark, value, T.truncate3, "double") == cut


def test_murmur3_published_values(spark):
    values = {"": 0, "foo": -156908512, "test": -1167338989, "Hello, world!": -1070186941, "hello": 613153351}
    for word, h in values.items():
        assert one(spark, word, murmur3) == h
    assert one(spark, "foo", lambda t: murmur3(t, 42)) == -1322301282
    assert one(spark, "foo", murmur3_bucket) == 156908512 % 512


def test_other_hashes_stay_in_range(spark):
    for make in (md5_bucket, spark_bucket):
        assert 0 <= one(spark, "free", make) < 512
    assert one(spark, "free", md5_bucket) == 79


def test_vector_functions(spark):
    row = spark.createDataFrame([([3, 1, 3, 3, 7],), ([],)], "b array<int>")
    counts = [[(e.value, e.n) for e in r[0]] for r in row.select(bucket_counts(F.col("b"))).collect()]
    assert counts == [[(1, 1), (3, 3), (7, 1)], []]
    unit = l2_normalize(bucket_counts(F.col("b")))
    vectors = [r[0] for r in row.select(unit).collect()]
    assert [round(e.x, 6) for e in vectors[0]] == [0.301511, 0.904534, 0.301511] and vectors[1] == []
    dense = [r[0] for r in row.select(to_dense(unit, 8)).collect()]
    assert [i for i, x in enumerate(dense[0]) if x] == [1, 3, 7] and dense[1] == [0.0] * 8
    weighted = row.withColumn("w", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: i.cast("double")))
    products = [r[0] for r in weighted.select(dot(bucket_counts(F.col("b")).cast("array<struct<bucket:int,x:double>>"), F.col("w"))).collect()]
    assert products == [17.0, 0.0]
    back = spark.createDataFrame([([0.0, 2.0, 0.0],)], "d array<double>").select(sparse_vector(F.col("d"))).first()[0]
    assert [(e.bucket, e.x) for e in back] == [(1, 2.0)]


def test_features_have_unit_length_or_none(spark):
    rows = spark.createDataFrame(
        [(1, "win", "free money money", "spam"), (2, "12", "!!", "ham"), (3, None, None, None), (4, "a", "b c d", "ham")],
        "row_id long, feature0 string, feature1 string, feature2 string",
    )
    made = {r.row_id: r for r in featurize(rows).collect()}
    assert abs(sum(e.x**2 for e in made[1].features) - 1) < 1e-12 and made[1].y == 1
    # One-letter words go, and with them the row's entries; the row stays.
    assert [made[i].features for i in (2, 3, 4)] == [[], [], []] and made[3].y == 0


def test_hash_is_an_option(spark):
    rows = spark.createDataFrame([("free", "money", "ham")], "feature0 string, feature1 string, feature2 string")
    md5 = featurize(rows, FeatureOptions(hash="md5")).first().features
    assert 79 in [e.bucket for e in md5]
    wide = featurize(rows, FeatureOptions(n_buckets=1 << 20)).first().features
    assert max(e.bucket for e in wide) > 512


def test_counts_by_distinct_word_equal_counts_by_word(spark, monkeypatch):
    """Words stemmed and hashed once per task: null, empty and repeated ones, strips of any size."""
    rng = random.Random(3)
    pieces = ["ational", "ing", "ied", "eed", "s", "sses", "logi", "alli", "ion", "e", "ll", "yyed", "dying", "bbing", "", "ies"]
    word = lambda: "".join(rng.choice("abeilostyz") for _ in range(rng.randint(1, 6))) + rng.choice(pieces)
    lists = [None, [], ["a"], ["as", "as"]] + [[word() for _ in range(rng.randint(0, 40))] for _ in range(200)] + [None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "id int, words array<string>").repartition(3)
    plain = bucket_counts(hash_buckets(T.vectorizer_tokens(stem_tokens(F.col("words")))))
    expected = {r.id: r.counts for r in df.select("id", plain.alias("counts")).collect()}
    for strip in (vectors.STRIP, 7):
        monkeypatch.setattr(vectors, "STRIP", strip)
        counted = vectors.count_words(pa.array(lists, pa.list_(pa.string())), 512).to_pylist()
        told = {i: None if c is None else [e.asDict() for e in c] for i, c in expected.items()}
        assert counted == [told[i] for i in range(len(lists))]
    made = df.select("id", vectors.stem_counts(F.col("words")).alias("counts"))
    assert {r.id: r.counts for r in made.collect()} == expected
    assert made.filter("id < 0").count() == 0

"""Every stage against a plain version of its rule, and the run against the stages."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from sieveline.llm import mixing, quality
from sieveline.llm.queries import tokenizer_path
from sieveline.sources.tables import load
from test_decontaminate import plain as plain_hits
from test_simhash import plain_fingerprint, plain_groups

SMALL = "/root/testdata/sf0.001"


def by_id(df):
    return sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()))


def test_stages_and_run(spark):
    docs = load(spark, SMALL, "documents")
    scored = {r.doc_id: r.predicted for r in quality.classify(docs, load(spark, SMALL, "labels")).collect()}
    expected = [r for r in by_id(docs) if scored[r[0]]]
    items = [(r.item_id, r.text) for r in load(spark, SMALL, "benchmark").collect()]

    stages = dict(P.STAGES)
    assert list(stages) == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "token files"]
    now = P.materialize(stages["quality classifier"](spark, docs, SMALL), "test")
    assert by_id(now) == expected

    groups = plain_groups([plain_fingerprint(r[1]) for r in expected])
    expected = [r for i, r in enumerate(expected) if groups[i] == i]
    now = P.materialize(stages["SimHash near-dedup"](spark, now, SMALL), "test")
    assert by_id(now) == expected

    def clean(text):
        n_words, n_hit, _ = plain_hits(text, items)
        return not (n_hit and 20 * n_hit >= n_words)

    expected = [r for r in expected if clean(r[1])]
    now = P.materialize(stages["benchmark decontamination"](spark, now, SMALL), "test")
    assert by_id(now) == expected

    copies = {r.doc_id: r.copies for r in mixing.mix(now).collect()}
    expected = sorted(r for r in expected for _ in range(copies[r[0]]))
    now = P.materialize(stages["mixing sources"](spark, now, SMALL), "test")
    assert by_id(now) == expected and now.columns == docs.columns

    tokenizer, start, tokens = Tokenizer.from_file(tokenizer_path()), 0, []
    for r in expected:
        ids = np.array([*tokenizer.encode(r[1], add_special_tokens=False).ids, 2], dtype="<u4")
        tokens.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    made = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in P.run(spark, SMALL).collect())
    assert made == sorted(tokens)


@pytest.mark.parametrize("at", range(4))
def test_stages_take_odd_rows(spark, at):
    docs = load(spark, SMALL, "documents").limit(30)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", "en", "a", 0), (7, "same text", None, None, 1), (7, "same text", None, None, 1)], docs.schema)
    made = P.STAGES[at][1](spark, docs.unionByName(odd), SMALL)
    assert made.columns == docs.columns and made.count() > 0
    assert P.STAGES[at][1](spark, docs.limit(0), SMALL).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    """Helpers' own names, a dot, and a clashing struct: all come out as they went in."""
    from pyspark.sql import functions as F

    from sieveline.llm import decontaminate, mixing, simhash

    names = ("_found", "_text_key", "_copies", "_time", "_key", "_id", "_source", "key", "row", "text_key", "a.b", "col")
    rows = [(i, f"word{i} " * 30 + "and some other words", "s1", "x" * i) for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept string")
    docs = docs.select("*", *[F.concat(F.lit(n), "kept").alias(n) for n in names])
    items = spark.createDataFrame([("i1", " ".join(f"item{i}" for i in range(20)))], "item_id string, text string")
    for made in (simhash.keep_one(docs), decontaminate.keep_clean(docs, items), mixing.repeat(docs)):
        assert made.columns == docs.columns
        got = made.distinct().collect()
        assert got and all(r[n] == n + r["kept"] for r in got for n in names)
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == {r.doc_id for r in decontaminate.keep_clean(docs, items).collect()}

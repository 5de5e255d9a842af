"""From raw documents to token files: the stages, in order, and the whole run.

A stage takes ``(spark, docs, sf_dir)`` and returns the documents that go on, with
all their columns; the last returns what the token files hold.  Every stage's result
is written to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import decontaminate, mixing, quality, simhash, token_store
from sieveline.llm.queries import tokenizer_path
from sieveline.session import materialize
from sieveline.sources.tables import load


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    return decontaminate.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files of the documents hold, read back."""
    return token_store.store_and_read(docs, tokenizer_path())


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("token files", tokens),
]

#: A trained classifier, fingerprints and a tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs

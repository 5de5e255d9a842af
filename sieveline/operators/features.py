"""Messages to feature rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import bind, run_lengths
from ..functions.hashing import BUCKETS, N_BUCKETS
from ..functions.porter import stem_tokens
from ..functions.vectors import bucket_counts, l2_normalize, stem_counts


@dataclass(frozen=True)
class FeatureOptions:
    """How a message becomes a vector."""

    hash: str = "murmur3"
    n_buckets: int = N_BUCKETS
    stop_words: tuple[str, ...] = tuple(T.STOP_WORDS)
    na_token: str | None = ""
    repr_compat: bool = False


@lru_cache(maxsize=16)
def _feature_column(options: FeatureOptions, context: SparkContext) -> Column:
    """The expression is long and the same for every table, so it is built once.

    The counts are those of ``vectorizer_tokens(preprocess_tokens(joint))``.  Words repeat,
    so each is stemmed and hashed once, in a task or, for other hashes than the default,
    in a message, and its bucket taken as often as it occurs.
    """
    joint = T.join_subject_message(F.col("feature0"), F.col("feature1"), options.na_token)
    words = T.remove_stopwords(T.tokenize(T.clean_text(joint, options.repr_compat)), options.stop_words)
    if options.hash == "murmur3":
        return l2_normalize(stem_counts(words, options.n_buckets))

    def taken(counted: Column) -> Column:
        stems = stem_tokens(F.transform(counted, lambda c: c.value))
        return F.flatten(F.zip_with(stems, counted, lambda s, c: F.when(
            F.length(s) > 1, F.array_repeat(BUCKETS[options.hash](s, options.n_buckets), c.n)
        ).otherwise(F.array().cast("array<int>"))))

    return l2_normalize(bucket_counts(bind(run_lengths(words), taken)))


def featurize(rows: DataFrame, options: FeatureOptions = FeatureOptions()) -> DataFrame:
    """Replace subject, message and label by ``y`` and a sparse unit vector
    ``features``.  One projection and no shuffle."""
    return rows.withColumns({
        "y": T.encode_label(F.col("feature2")),
        "features": _feature_column(options, rows.sparkSession.sparkContext),
    }).drop("feature0", "feature1", "feature2")


def feature_entries(rows: DataFrame, *keep: str) -> DataFrame:
    """The vectors in long form: the columns to keep, ``bucket`` and ``x``.

    The outer generator avoids a test of the array's size, which the optimiser
    would put below the projection that computes the array.
    """
    return rows.select(*keep, F.inline_outer("features")).filter(F.col("bucket").isNotNull())

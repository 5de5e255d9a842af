"""Sparse feature vectors held as ``array<struct<bucket int, x double>>`` in one row.

A vector never has more entries than buckets, so a row stays small however long
its text was, and building, normalising and scoring it need no shuffle.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import bind, laid_out, run_lengths
from .hashing import BUCKETS, N_BUCKETS, murmur3_of
from .porter import stem_word

#: Words a task remembers with their buckets, and words counted at a time.
REMEMBERED, STRIP = 1 << 18, 1 << 20


def hash_buckets(tokens: Column, method: str = "murmur3", n_buckets: int = N_BUCKETS) -> Column:
    """Bucket of every token, in token order."""
    return F.transform(tokens, lambda t: BUCKETS[method](t, n_buckets))


def bucket_counts(buckets: Column) -> Column:
    """Term frequencies: ``array<struct<value int, n int>>`` by ascending bucket."""
    return run_lengths(buckets)


@lru_cache(maxsize=REMEMBERED)
def _bucket(word: str, n_buckets: int) -> int:
    """The bucket of a word's stem by MurmurHash3; -1 if the vectoriser does not see the stem."""
    stem = stem_word(word)
    return abs(murmur3_of(stem.encode())) % n_buckets if len(stem) > 1 else -1


def count_words(words: pa.Array, n_buckets: int) -> pa.Array:
    """Counts by bucket of every row of an array of words, ``STRIP`` words or a row at a time."""
    upto = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    strips = np.flatnonzero(np.diff(upto // STRIP, prepend=-1)) if len(upto) else [0]
    strips = np.append(strips, len(words))
    return pa.concat_arrays([_counted(words.slice(a, b - a), n_buckets) for a, b in zip(strips[:-1], strips[1:])])


def _counted(words: pa.Array, n_buckets: int) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    spelt = words.flatten().dictionary_encode()
    buckets = np.array([_bucket(w, n_buckets) for w in spelt.dictionary.to_pylist()], dtype=np.int64)
    found, rows = buckets[spelt.indices.to_numpy(zero_copy_only=False)], np.repeat(np.arange(len(words)), sizes)
    seen = found >= 0
    keys, n = np.unique(rows[seen] * n_buckets + found[seen], return_counts=True)
    entries = pa.StructArray.from_arrays(
        [pa.array((keys % n_buckets).astype(np.int32)), pa.array(n.astype(np.int32))], names=["value", "n"]
    )
    starts = np.searchsorted(keys // n_buckets, np.arange(len(words) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), entries, mask=words.is_null())


def stem_counts(words: Column, n_buckets: int = N_BUCKETS) -> Column:
    """``bucket_counts(hash_buckets(vectorizer_tokens(stem_tokens(words))))`` for words of the
    letters a to z.

    Words repeat from row to row, so a task stems and hashes each distinct one once.
    """
    @F.arrow_udf("array<struct<value: int, n: int>>")
    def count(column: pa.Array) -> pa.Array:
        return count_words(column, n_buckets)

    return count(words)


def l2_normalize(counts: Column) -> Column:
    """Counts divided by their Euclidean norm; an empty vector stays empty."""
    def scale(c: Column) -> Column:
        norm = F.sqrt(F.aggregate(c, F.lit(0).cast("long"), lambda acc, e: acc + e.n.cast("long") * e.n))
        return bind(norm, lambda m: F.transform(
            c, lambda e: F.struct(e.value.alias("bucket"), (e.n / m).alias("x"))
        ))

    return bind(counts, scale)


def sparse_vector(dense: Column) -> Column:
    """The non-zero entries of a dense array."""
    return F.filter(
        F.transform(dense, lambda v, i: F.struct(i.alias("bucket"), v.cast("double").alias("x"))),
        lambda e: e.x != 0,
    )


def to_dense(vector: Column, n_buckets: int = N_BUCKETS) -> Column:
    """``array<double>`` of fixed width with zeros where the vector has no entry."""
    entries = F.transform(F.sort_array(vector), lambda e: F.struct(e.bucket.alias("at"), e.x.alias("value")))
    return laid_out(entries, F.lit(n_buckets), F.lit(0.0))


def dot(vector: Column, weights: Column) -> Column:
    """Inner product of a sparse vector with a dense ``array<double>``.

    ``weights`` must be a plain column: it is indexed once per entry.
    """
    return F.aggregate(vector, F.lit(0.0), lambda acc, e: acc + e.x * F.get(weights, e.bucket))


def squared_norm(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w * w)

"""Benchmark passages in documents, by a prefix-filtered containment join.

A benchmark item is cut into windows of consecutive words; an item of fewer words
is one window.  A window's shingles are ordered by how often they occur in the
corpus.  Exact containment needs every shingle, so the necessary prefix is the
rarest one alone: only documents that hold it can hold the window, and windows with
a shingle the corpus lacks are out at once.  Where a document has the prefix
shingle, its place in the window fixes where the window would start; starts and
ends outside the document are dropped, the rest is verified word by word.

Defined results.  A null or empty text has no words and no hits; so has a document
without words.  An item without words has no window.  A null ``item_id`` is listed
as the empty string.  Repeated rows and ids are each handled as a row of their own.
Columns other than those named are ignored and may have any name.  Empty tables
give no hits, or an empty result.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import raw_texts, release, shingle_hashes, split_words, word_hashes

#: Contract: words of a window.  Words of a shingle, or the whole of a shorter window.
WINDOW, SHINGLE = 13, 5
#: Share of a document's words that make it contaminated: one in so many.
ONE_IN = 20
#: Shingles, and windows, that are sent to all tasks; above that they are joined.
MAX_SENT_SHINGLES, MAX_SENT_WINDOWS = 2_000_000, 100_000


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``window_id, item_id, n, words, at, k, hash``: a row per shingle of a window,
    ``at`` words from its start and ``k`` words long."""
    def cut(batches):
        for batch in batches:
            out = defaultdict(list)
            for item, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                words = split_words(raw)
                n = min(window, len(words))
                k = min(shingle, n)
                if not n:
                    continue
                text = b" ".join(words)
                hashes, _ = shingle_hashes(*word_hashes([text]), k)
                for start in range(len(words) - n + 1):
                    joined = b" ".join(words[start:start + n])
                    for at in range(n - k + 1):
                        out["item_id"].append(item)
                        out["n"].append(n)
                        out["words"].append(joined)
                        out["at"].append(at)
                        out["k"].append(k)
                        out["hash"].append(int(hashes[start + at].view(np.int64)))
            yield pa.RecordBatch.from_pydict(dict(out), schema=layout) if out else layout.empty_table().to_batches()[0]

    layout = pa.schema([
        ("item_id", pa.string()), ("n", pa.int32()), ("words", pa.binary()), ("at", pa.int32()),
        ("k", pa.int32()), ("hash", pa.int64()),
    ])
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    made = rows.mapInArrow(cut, "item_id string, n int, words binary, at int, k int, hash long")
    return made.withColumn("window_id", F.xxhash64("item_id", "words"))


def _occurrences(docs: DataFrame, wanted: DataFrame, lengths: list[int], max_sent: int) -> DataFrame:
    """``hash, seen``: how often each wanted shingle occurs in all documents."""
    known = _array(wanted) if wanted.count() <= max_sent else None

    def count(batches):
        for batch in batches:
            words, counts = word_hashes(raw_texts(batch.column(0)))
            for k in lengths:
                hashes, _ = shingle_hashes(words, counts, k)
                if known is not None:
                    hashes = hashes[_among(hashes, known)]
                hashes, seen = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(seen)], ["hash", "seen"])

    found = docs.select("text").mapInArrow(count, "hash long, seen long")
    if known is None:
        found = found.join(wanted, "hash", "left_semi")
    return found.groupBy("hash").agg(F.sum("seen").alias("seen"))


def _array(hashes: DataFrame) -> np.ndarray:
    """A table of checked size as a sorted array."""
    values = hashes.toArrow().column(0).to_numpy() if not hashes.isEmpty() else np.zeros(0, dtype=np.int64)
    return np.sort(values.astype(np.int64).view(np.uint64))


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), dtype=bool)
    at = np.searchsorted(known, hashes)
    return known[np.minimum(at, len(known) - 1)] == hashes


def prefixes(docs: DataFrame, items: DataFrame, window: int, shingle: int, max_sent: int) -> DataFrame:
    """One row per window that the corpus may hold: its rarest shingle."""
    rows = materialize(item_windows(items, window, shingle), "windows")
    lengths = sorted(r.k for r in rows.select("k").distinct().collect())  # at most `shingle` numbers
    seen = _occurrences(docs, rows.select("hash").distinct(), lengths, max_sent)
    ranked = rows.join(seen, "hash", "left").groupBy("window_id", "item_id", "n", "words").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "hash", "at", "k")).alias("rarest")
    )
    return materialize(
        ranked.filter("rarest.seen > 0").select("item_id", "n", "words", "rarest.hash", "rarest.at", "rarest.k"),
        "prefixes",
    )


def _verify(words: list[bytes], candidates) -> tuple[int, list[str]]:
    """Words hit by, and ids of, the ``(start, window, item)`` that really occur."""
    edges, found = np.zeros(len(words) + 1, dtype=np.int64), set()
    for start, window, item in candidates:
        n = len(window)
        if 0 <= start <= len(words) - n and words[start:start + n] == window:
            edges[start] += 1
            edges[start + n] -= 1
            found.add(item)
    return int((np.cumsum(edges) > 0).sum()), sorted(found)


RESULT = "struct<n_words:bigint,n_hit:bigint,items:array<string>>"
_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))])


def find(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
    max_shingles: int = MAX_SENT_SHINGLES, max_windows: int = MAX_SENT_WINDOWS,
) -> DataFrame:
    """``docs`` with ``_found``: its number of words, the words inside benchmark
    windows, and the ids of the items they are from.

    Few windows travel to the documents, which then do not move at all; many are
    joined by their prefix shingle.  The limits decide the way, not the result.
    """
    rare = prefixes(docs, items, window, shingle, max_shingles)
    if rare.count() <= max_windows:
        return _found_by_sent(docs, rare)
    return _found_by_join(docs, rare)


def _found_by_sent(docs: DataFrame, rare: DataFrame) -> DataFrame:
    by_hash, lengths = defaultdict(list), set()
    for r in rare.collect():  # at most max_windows
        by_hash[r.hash % 2**64].append((r.at, bytes(r.words).split(), r.item_id))
        lengths.add(r.k)
    known = np.sort(np.array(list(by_hash), dtype=np.uint64))
    at = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(dict(by_hash))

    def look(batches):
        for batch in batches:
            raws = raw_texts(batch.column(at))
            hashed, counts = word_hashes(raws)
            first_word = np.cumsum(counts) - counts
            candidates = defaultdict(list)
            for k in sorted(lengths):
                hashes, first = shingle_hashes(hashed, counts, k)
                hit = np.flatnonzero(_among(hashes, known))
                owner = np.searchsorted(first_word, first[hit], side="right") - 1
                # Texts without words share their first word with the next text.
                for h, place, doc in zip(hashes[hit].tolist(), first[hit].tolist(), owner.tolist()):
                    for offset, words, item in sent.value[h]:
                        candidates[doc].append((place - int(first_word[doc]) - offset, words, item))
            results = [
                (n, *(_verify(split_words(raws[i]), candidates[i]) if i in candidates else (0, [])))
                for i, n in enumerate(counts.tolist())
            ]
            column = pa.array([dict(zip(("n_words", "n_hit", "items"), r)) for r in results], type=_RESULT)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "_found"])
        release()

    return docs.mapInArrow(look, _with(docs, "_found", RESULT))


def _with(docs: DataFrame, name: str, kind: str):
    return docs.select("*", F.lit(None).cast(kind).alias(name)).schema


def _found_by_join(docs: DataFrame, rare: DataFrame) -> DataFrame:
    lengths = sorted(r.k for r in rare.select("k").distinct().collect())

    def emit(batches):
        for batch in batches:
            hashed, counts = word_hashes(raw_texts(batch.column(1)))
            first_word = np.cumsum(counts) - counts
            for k in lengths:
                hashes, first = shingle_hashes(hashed, counts, k)
                owner = np.searchsorted(first_word, first, side="right") - 1
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(owner)), pa.array(hashes.view(np.int64)),
                    pa.array(first - first_word[owner]),
                ], ["text_key", "hash", "place"])

    keyed = docs.withColumn("_text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = keyed.select(F.col("_text_key").alias("text_key"), "text").dropDuplicates(["text_key"])
    hits = texts.mapInArrow(emit, "text_key string, hash long, place long").join(rare, "hash")
    candidates = hits.filter("place >= at").groupBy("text_key").agg(
        F.collect_list(F.struct((F.col("place") - F.col("at")).alias("start"), "words", "item_id")).alias("candidates")
    )
    pairs = keyed.join(candidates.withColumnRenamed("text_key", "_text_key"), "_text_key", "left")
    pairs = pairs.select(*docs.columns, F.col("candidates").alias("_candidates"))
    at = docs.columns.index("text")

    def look(batches):
        for batch in batches:
            results = []
            for raw, found in zip(raw_texts(batch.column(at)), batch.column(len(batch.columns) - 1).to_pylist()):
                words = split_words(raw)
                tried = [(c["start"], bytes(c["words"]).split(), c["item_id"]) for c in found or ()]
                results.append(dict(zip(("n_words", "n_hit", "items"), (len(words), *_verify(words, tried)))))
            column = pa.array(results, type=_RESULT)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*batch.schema.names[:-1], "_found"])

    return pairs.mapInArrow(look, _with(docs, "_found", RESULT))


def contaminated():
    """Whether hits make up at least one in ONE_IN of the words."""
    return (F.col("_found.n_hit") > 0) & (ONE_IN * F.col("_found.n_hit") >= F.col("_found.n_words"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    # All but the text goes along packed, so that the columns may have any name.
    others = [c for c in docs.columns if c != "text"]
    found = find(docs.select("text", F.struct(*[docs[f"`{c}`"] for c in others]).alias("row")), items)
    clean = found.filter(~contaminated())
    return clean.select(*["text" if c == "text" else clean["row"][c].alias(c) for c in docs.columns])

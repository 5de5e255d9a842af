"""Near-duplicate groups by SimHash fingerprints and multi-index hashing.

A fingerprint is the bitwise majority over the XXH64 values of a text's shingles.
Two fingerprints link if at most three bits differ.  Then one of their two halves
differs in at most one bit, so it is enough to look up, for each half, the half
itself and every half one bit away, and to verify whole distances of the matches.

Defined results.  A null or empty text has no words and fingerprint zero, which
links like any other.  Fewer words than a shingle make one shingle of them all.
Rows with the same ``doc_id`` or text are kept and share a component.  A null
``doc_id`` keeps its fingerprint and gets the component of equal or linked
fingerprints; the component is null only if no member has an id.  Other columns
are ignored and may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected
from .words import raw_texts

#: Contract: words per shingle, hash seed, and the largest linked distance.
SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints of one half-table entry that are paired directly; a fuller entry
#: is looked up by longer keys first.
FULL_ENTRY = 64


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text's UTF-8 bytes; words are runs of non-blank characters."""
    words = raw.lower().split()  # bytes: only ASCII letters and blanks are touched
    if not words:
        return 0
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[s:e], SEED) for s, e in zip(starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())),
        dtype=np.uint64, count=len(words) - n + 1,
    )
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8)
        bits += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp`` (the 64 bits as a signed long), one row per document row."""
    def compute(batches):
        for batch in batches:
            values = np.array([fingerprint(raw, shingle) for raw in raw_texts(batch.column(2))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["doc_id", "text_key", "fp"]
            )

    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(compute, rows.select("doc_id", "text_key").schema.add("fp", "long"))


def _ball(value, width: int, both_ways: bool) -> Column:
    """``value`` and its neighbours one bit away; of each pair of neighbours only
    the one with the bit unset looks for the other, unless ``both_ways``."""
    flips = [
        value.bitwiseXOR(F.lit(1 << i)) if both_ways
        else F.when(value.bitwiseAND(F.lit(1 << i)) == 0, value.bitwiseOR(F.lit(1 << i)))
        for i in range(width)
    ]
    return F.array_compact(F.array(value, *flips))


def _tagged(subs: Column, quarter: int) -> Column:
    return F.transform(subs, lambda s: F.struct(F.lit(quarter).alias("quarter"), s.alias("sub")))


def _half(which: int) -> Column:
    fp = F.col("fp")
    return F.shiftrightunsigned(fp, 32) if which else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _verified(probes: DataFrame, entries: DataFrame, on: list[str]) -> DataFrame:
    """Links among the matches of ``probes`` and ``entries``."""
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    return (
        probes.join(entries.withColumnRenamed("fp", "other"), on)
        .filter((distance >= 1) & (distance <= DISTANCE))
        .filter((F.col("key") != F.col("own")) | (F.col("fp") < F.col("other")))
        .select(F.col("fp").alias("u"), F.col("other").alias("v"))
    )


def links(distinct: DataFrame, full_entry: int = FULL_ENTRY) -> DataFrame:
    """All pairs ``u, v`` of different fingerprints at most three bits apart, found
    through at least one half; ``distinct`` has one row per fingerprint ``fp``.

    Entries fuller than ``full_entry`` are split by the quarters of the other half:
    it differs in at most three bits, so one of its quarters in at most one.  Then
    an entry holds at most 65,536 fingerprints whatever the input.  The limit
    decides the way, not the result.
    """
    halves = F.array(*[
        F.struct(F.lit(t).alias("half"), _half(t).alias("own"), _half(1 - t).alias("rest")) for t in (0, 1)
    ])
    sides = distinct.select("fp", F.inline(halves))
    entries = sides.select("fp", "half", F.col("own").alias("key"), "rest")
    probes = sides.select("fp", "half", "own", "rest", F.explode(_ball(F.col("own"), 32, False)).alias("key"))
    full = entries.groupBy("half", "key").count().filter(F.col("count") > full_entry).select("half", "key")
    full = materialize(full, "full-entries")
    on = ["half", "key"]
    if full.isEmpty():
        return _verified(probes, entries.drop("rest"), on)
    direct = _verified(probes, entries.drop("rest").join(full, on, "left_anti"), on)
    quarters = [F.shiftright("rest", 16), F.col("rest").bitwiseAND(F.lit(0xFFFF))]
    exact = F.array(*[F.struct(F.lit(i).alias("quarter"), q.alias("sub")) for i, q in enumerate(quarters)])
    near = F.concat(*[_tagged(_ball(q, 16, True), i) for i, q in enumerate(quarters)])
    split = _verified(
        probes.join(full, on, "left_semi").select("fp", "half", "own", "key", F.inline(near)),
        entries.join(full, on, "left_semi").select("fp", "half", "key", F.inline(exact)),
        [*on, "quarter", "sub"],
    )
    return direct.unionByName(split)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, full_entry: int = FULL_ENTRY) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id``, one row per document row.

    Equal fingerprints are one node of the link graph, so copies are never paired.
    ``text_key`` is a hash of the text that tells rows of one ``doc_id`` apart;
    ``root`` is the smallest fingerprint of the component.
    """
    own = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected(links(nodes.select("fp"), full_entry)).withColumnsRenamed({"u": "fp", "v": "root"})
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(placed.join(least, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` with one left of each group of near-duplicates: the one
    with the smallest ``doc_id`` (null last), of equal ids the smallest text key."""
    groups = near_duplicates(docs, shingle)
    # Rows of a group agree in component_id unless none of them has an id.
    without = F.col("component_id").isNull()
    kept = groups.groupBy(without.alias("without"), F.coalesce("component_id", "root").alias("group")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best")
    ).select(F.col("best.doc_id").alias("_id"), F.col("best.text_key").alias("_key"))
    # The rows go along packed, so that their columns may have any name.
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    same = rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["key"] == kept["_key"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "key"]).select("row.*")

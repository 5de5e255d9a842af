"""Removal of long byte strings that occur more than once, by suffix sorting.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else.
Texts are too large to be sorted as one, so candidates that may be equal are brought
together first, and suffix arrays by linear grouping decide:

1. Every window of LENGTH bytes has an anchor: its substring of ANCHOR bytes with the
   smallest hash.  Equal windows have equal anchors at the same place, so windows
   whose anchor's hash occurs once in the corpus are unique.
2. Consecutive windows with the same anchor form a segment.  Equal segments with a
   repeated anchor are counted together.
3. The distinct segments of an anchor are written one after another as numbers of
   their blocks of BLOCK bytes, lined up at the anchor, and suffix sorted.  Windows
   that share all their whole blocks are neighbours in that order; the bytes at their
   ends are compared directly.
4. An anchor with more than FULL distinct segments is split by longer anchors, until
   in the end the anchor is the window itself; so no task gets an unbounded group.

Defined results.  A null text counts as empty; texts shorter than LENGTH bytes stay
whole.  Repeated rows are occurrences of their own and remove each other.  A null
``doc_id`` is a document like any other.  Columns other than ``doc_id`` and ``text``
are ignored and may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .suffix_array import suffix_array
from .words import mix, raw_texts

#: Contract: length of the strings.
LENGTH = 200
#: Bytes of an anchor, and of a block of the sorted sequences.
ANCHOR, BLOCK = 64, 32
#: Distinct segments of an anchor that are sorted together.
FULL = 8192
#: Bytes of segments per suffix array, and window starts handled at a time.
SORTED_BYTES, PIECE = 1 << 18, 1 << 19
#: Repeated anchors, of 8 bytes each, that travel to all tasks.
MAX_SENT_ANCHORS = 2_000_000

_WINDOWS = LENGTH - ANCHOR + 1  # anchors to choose from in a window
_FACTOR = 0x9E3779B97F4A7C15
_TABLES: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _TABLES:
        n = PIECE + LENGTH
        inverse = pow(_FACTOR, -1, 1 << 64)
        _TABLES.extend(np.cumprod(np.full(n, f, dtype=np.uint64)) for f in (_FACTOR, inverse))
    return _TABLES


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor start, first window start and window count of every segment."""
    found = [_piece_anchors(raw[at:at + PIECE + LENGTH - 1], at) for at in range(0, len(raw) - LENGTH + 1, PIECE)]
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _piece_anchors(raw: bytes, base: int):
    up, down = _powers()
    data = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data * up[:len(data)], out=sums[1:])
    hashes = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * down[:len(data) - ANCHOR + 1])
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    low = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= _WINDOWS:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if _WINDOWS > span:
        low = np.minimum(low[:span - _WINDOWS], low[_WINDOWS - span:])
    place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    count = np.diff(np.append(first, len(place)))
    return hashes[place[first]], place[first] + base, first + base, count


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tk"), "doc_id", "text",
    )


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """``h``: anchor hashes of at least two segments of the corpus."""
    def packed(batches):
        """Counts of a whole batch at once; the shuffle adds the rest."""
        for batch in batches:
            parts = [anchors(raw)[0] for raw in raw_texts(batch.column(0))]
            hashes, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["h", "n"])

    counted = docs.select("text").mapInArrow(packed, "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")


def segments_of(docs: DataFrame, repeated: DataFrame, max_sent: int = MAX_SENT_ANCHORS) -> DataFrame:
    """``h, sid, did, tk, lo, n, off``: every segment with a repeated anchor; ``sid``
    names its content, ``lo`` is its first window, ``off`` where in it the anchor is.

    Few repeated anchors travel to the texts; many are joined with the anchors and
    come back as a list per document.
    """
    known = None
    if repeated.count() <= max_sent:
        known = np.sort(repeated.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))
        rows = docs.select("did", "tk", "text")
    else:
        rows = docs.join(_repeated_by_document(docs, repeated), ["did", "tk"]).select("did", "tk", "text", "own")

    def emit(batches):
        for batch in batches:
            out = {name: [] for name in ("h", "sid", "did", "tk", "lo", "n", "off")}
            dids, tks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            owns = batch.column(3).to_pylist() if known is None else [None] * len(dids)
            for did, tk, raw, own in zip(dids, tks, raw_texts(batch.column(2)), owns):
                h, place, lo, n = anchors(raw)
                among = known if own is None else np.sort(np.array(own, dtype=np.int64).view(np.uint64))
                if not len(among) or not len(h):
                    continue
                at = np.minimum(np.searchsorted(among, h), len(among) - 1)
                kept = np.flatnonzero(among[at] == h)
                off = (place - lo)[kept].tolist()
                los, ns = lo[kept].tolist(), n[kept].tolist()
                out["h"] += h[kept].view(np.int64).tolist()
                out["sid"] += [
                    xxhash.xxh3_128_digest(raw[a:a + c + LENGTH - 1], o) for a, c, o in zip(los, ns, off)
                ]
                out["did"] += [did] * len(kept)
                out["tk"] += [tk] * len(kept)
                out["lo"] += los
                out["n"] += ns
                out["off"] += off
            yield pa.RecordBatch.from_pydict(out, schema=layout)

    layout = pa.schema([
        (name, pa.binary() if name == "sid" else pa.int64() if name in ("h", "did", "tk", "lo") else pa.int32())
        for name in ("h", "sid", "did", "tk", "lo", "n", "off")
    ])
    return rows.mapInArrow(emit, "h long, sid binary, did long, tk long, lo long, n int, off int")


def _repeated_by_document(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    def emit(batches):
        for batch in batches:
            for did, tk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2))):
                h = np.unique(anchors(raw)[0]).view(np.int64)
                yield pa.RecordBatch.from_pydict({"did": [did] * len(h), "tk": [tk] * len(h), "h": h}, schema=layout)

    layout = pa.schema([("did", pa.int64()), ("tk", pa.int64()), ("h", pa.int64())])
    own = docs.select("did", "tk", "text").mapInArrow(emit, "did long, tk long, h long")
    return own.join(repeated, "h", "left_semi").groupBy("did", "tk").agg(F.collect_set("h").alias("own"))


def distinct_segments(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``h, sid, off, n, weight, bytes``: each distinct segment, cut from one of the
    documents that hold it, with its number of occurrences.

    Where the row of that document is repeated, the segment comes as often; that
    changes nothing, for it occurs more than once then and so do all its windows.
    """
    chosen = places.groupBy("h", "sid").agg(
        F.min(F.struct("did", "tk", "lo", "n", "off")).alias("at"), F.count("*").alias("weight")
    )
    cuts = materialize(
        chosen.groupBy("at.did", "at.tk").agg(
            F.collect_list(F.struct("h", "sid", "at.lo", "at.n", "at.off", "weight")).alias("cuts")
        ), "cuts",
    )
    texts = docs.join(cuts, ["did", "tk"]).select("text", "cuts")

    def cut(batches):
        for batch in batches:
            out = []
            for raw, cuts in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
                for c in cuts:
                    end = c["lo"] + c["n"] + LENGTH - 1
                    out.append((c["h"], c["sid"], c["off"], c["n"], c["weight"], raw[c["lo"]:end]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, type=f.type) for column, f in zip(zip(*out) if out else [[]] * 6, layout)], schema=layout
            )

    layout = pa.schema([
        ("h", pa.int64()), ("sid", pa.binary()), ("off", pa.int32()), ("n", pa.int32()), ("weight", pa.int64()),
        ("bytes", pa.binary()),
    ])
    return texts.mapInArrow(cut, "h long, sid binary, off int, n int, weight long, bytes binary")


def split_full(segments: DataFrame, full: int = FULL) -> tuple[DataFrame, DataFrame]:
    """Segments with no anchor left that has more than ``full``, and ``sid, shift,
    part``: which part of a segment became which new one, and where it starts.

    A class of windows has ``a`` to ``z`` bytes before the anchor.  Halving the class
    lengthens the substring its windows share by as much.
    """
    rows = materialize(segments.withColumns({"a": F.lit(0), "z": F.lit(LENGTH - ANCHOR)}), "segments")
    done, moves = [], []
    links = rows.select("sid", F.lit(0).alias("shift"), F.col("sid").alias("part"))
    while True:
        large = materialize(rows.groupBy("h").count().filter(F.col("count") > full).select("h"), "full-anchors")
        if large.isEmpty():
            break
        done.append(rows.join(large, "h", "left_anti"))
        kept = links.join(done[-1].select(F.col("sid").alias("part")).distinct(), "part", "left_semi")
        moves.append(kept.select("sid", "shift", "part"))
        middle = F.floor((F.col("a") + F.col("z")) / 2).cast("int")
        halves = F.array(F.struct(F.col("a").alias("a"), middle.alias("z")), F.struct((middle + 1).alias("a"), F.col("z").alias("z")))
        pieces = rows.join(large, "h", "left_semi").withColumn("half", F.explode(halves)).withColumns({
            "most": F.least(F.col("half.z"), F.col("off")),
            "least": F.greatest(F.col("half.a"), F.col("off") - F.col("n") + 1),
        }).filter("least <= most")
        cut = F.substring("bytes", F.col("off") - F.col("most") + 1, F.col("most") - F.col("least") + LENGTH)
        core = F.substring("bytes", F.col("off") - F.col("half.a") + 1, F.col("half.a") - F.col("half.z") + LENGTH)
        pieces = pieces.select(
            F.xxhash64(core, "half.a", "half.z").alias("h"), F.col("sid").alias("whole"),
            (F.col("off") - F.col("most")).alias("delta"), F.col("most").alias("off"),
            (F.col("most") - F.col("least") + 1).cast("int").alias("n"), "weight", cut.alias("bytes"),
            F.col("half.a").alias("a"), F.col("half.z").alias("z"),
        ).withColumn("sid", F.unhex(F.substring(F.sha2(
            F.concat(F.col("bytes"), F.to_binary(F.concat_ws(",", "off", "a", "z", "h"), F.lit("utf-8"))), 256), 1, 32)))
        pieces = materialize(pieces, "pieces")
        links = links.withColumnRenamed("part", "whole").join(pieces.select("whole", "delta", F.col("sid").alias("part")), "whole").select(
            "sid", (F.col("shift") + F.col("delta")).alias("shift"), "part"
        )
        links = materialize(links, "links")
        rows = materialize(pieces.groupBy("h", "sid", "off", "n", "a", "z").agg(
            F.first("bytes").alias("bytes"), F.sum("weight").alias("weight")
        ), "segments")
    for part in done:
        rows = rows.unionByName(part.select(rows.columns))
    for part in moves:
        links = links.unionByName(part)
    return rows, links


def repeated_windows(segments: list[tuple[bytes, int, int, int]]) -> list[np.ndarray]:
    """For ``(bytes, off, n, weight)`` segments, which of the ``n`` windows of each
    occur more than once among all of them, an occurrence counting ``weight`` times."""
    whole = (LENGTH - BLOCK + 1) // BLOCK  # blocks that lie in any window, wherever it starts in a block
    numbers: dict[bytes, int] = {}
    values, owner, start = [], [], []
    for i, (data, off, _, _) in enumerate(segments):
        places = range(off % BLOCK, len(data) - BLOCK + 1, BLOCK)
        values += [numbers.setdefault(data[p:p + BLOCK], len(numbers)) for p in places]
        values.append(-1 - i)  # separators differ from each other and from all blocks
        owner += [i] * (len(places) + 1)
        start += [*places, len(data)]

    flags = [np.zeros(n, dtype=bool) for _, _, n, _ in segments]

    def close(run: list[tuple[int, int]]) -> None:
        """Decide the windows that start in the block before each place of a run."""
        if len(run) == 1:
            i, p = run[0]
            if segments[i][3] > 1:
                flags[i][max(0, p - BLOCK + 1):p + 1] = True
            return
        for t in range(BLOCK):
            windows = [(i, p - t) for i, p in run if 0 <= p - t < segments[i][2]]
            edges = [segments[i][0][s:s + t] + segments[i][0][s + t + whole * BLOCK:s + LENGTH] for i, s in windows]
            seen: dict[bytes, int] = {}
            for (i, _), edge in zip(windows, edges):
                seen[edge] = seen.get(edge, 0) + segments[i][3]
            for (i, s), edge in zip(windows, edges):
                flags[i][s] = seen[edge] > 1

    run, shared = [], b""
    for at in suffix_array(values):
        i, p = owner[at], start[at]
        data = segments[i][0][p:p + whole * BLOCK]
        if len(data) < whole * BLOCK:
            continue
        if data != shared and run:
            close(run)
            run = []
        shared = data
        run.append((i, p))
    if run:
        close(run)
    return flags


def flagged(segments: DataFrame) -> DataFrame:
    """``part, from, upto``: ranges of repeated windows of each segment that has any."""
    def sort_blocks(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if size >= SORTED_BYTES and row["h"] != last:
                    yield ranges(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
                last = row["h"]
        if held:
            yield ranges(held)

    def ranges(rows):
        out = []
        for row, flags in zip(rows, repeated_windows([(r["bytes"], r["off"], r["n"], r["weight"]) for r in rows])):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
            out += [(row["sid"], a, b) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(zip(*out) if out else [[]] * 3, layout)], schema=layout)

    layout = pa.schema([("part", pa.binary()), ("from", pa.int32()), ("upto", pa.int32())])
    rows = segments.select("h", "sid", "off", "n", "weight", "bytes")
    return rows.repartition("h").sortWithinPartitions("h", "sid").mapInArrow(sort_blocks, "part binary, from int, upto int")


_RUNS = pa.list_(pa.struct([("from", pa.int64()), ("upto", pa.int64())]))


def repeated_spans(
    docs: DataFrame, full: int = FULL, max_anchors: int = MAX_SENT_ANCHORS
) -> DataFrame:
    """``did, tk, spans``: byte ranges of each document inside repeated strings."""
    repeated = materialize(repeated_anchors(docs), "anchors")
    places = materialize(segments_of(docs, repeated, max_anchors), "places")
    segments, links = split_full(distinct_segments(docs, places), full)
    found = links.join(flagged(segments), "part").groupBy("sid").agg(
        F.collect_set(F.struct(
            (F.col("shift") + F.col("from")).alias("from"), (F.col("shift") + F.col("upto")).alias("upto")
        )).alias("ranges")  # at most a segment's windows
    )
    found = materialize(found, "flags")
    span = F.transform("ranges", lambda r: F.struct(
        (F.col("lo") + r["from"]).alias("from"), (F.col("lo") + r["upto"] + LENGTH - 1).alias("upto")))
    spans = places.join(found, "sid").select("did", "tk", span.alias("spans")).groupBy("did", "tk").agg(
        F.flatten(F.collect_list("spans")).alias("spans")  # of one document
    )

    def merge(batches):
        for batch in batches:
            runs = [
                [{"from": a, "upto": b} for a, b in merged([(s["from"], s["upto"]) for s in own])]
                for own in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(runs, type=_RUNS)], ["did", "tk", "spans"])

    return spans.mapInArrow(merge, "did long, tk long, spans array<struct<from:bigint,upto:bigint>>")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs


def remove_repeats(
    docs: DataFrame, full: int = FULL, max_anchors: int = MAX_SENT_ANCHORS
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, runs``, one row per document
    row; ``runs`` are the removed byte ranges."""
    keyed = _documents(docs)
    spans = materialize(repeated_spans(keyed, full, max_anchors), "spans")
    rows = keyed.join(spans, ["did", "tk"], "left").select("doc_id", "text", "spans")

    def finish(batches):
        for batch in batches:
            out = []
            for doc_id, raw, spans in zip(
                batch.column(0).to_pylist(), raw_texts(batch.column(1)), batch.column(2).to_pylist()
            ):
                runs = [(s["from"], s["upto"]) for s in spans or ()]
                kept, at = hashlib.sha256(), 0
                for a, b in [*runs, (len(raw), len(raw))]:
                    kept.update(raw[at:a])
                    at = b
                out.append({
                    "doc_id": doc_id, "n_bytes": len(raw), "n_removed": sum(b - a for a, b in runs),
                    "n_spans": len(runs), "kept_sha256": kept.hexdigest(),
                    "runs": [{"from": a, "upto": b} for a, b in runs],
                })
            yield pa.RecordBatch.from_pylist(out, schema=layout)

    layout = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), ("runs", _RUNS),
    ])
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(
        finish,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "runs array<struct<from:bigint,upto:bigint>>",
    )

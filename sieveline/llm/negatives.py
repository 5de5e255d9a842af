"""Hard negatives by branch-and-bound on decomposed vectors (BOND).

Vectors are kept column by column (de Vries et al. 2002).  A task holds a shard of the
candidates, one array per dimension with its smallest and largest value.  For an
anchor the dimensions are read in descending order of the anchor's own magnitudes;
after every few of them, the best and the worst that the unread ones can still add
bound each candidate's score, and the bitmap of candidates shrinks to those whose
bounds can still matter.  Scores are whole numbers, so nothing depends on the order
of adding.

There are two scans.  The first finds an anchor's positives, the best of its own label.
Each positive's score opens a window, ``low`` to ``high`` hundredths of it, and the second
scan resolves the windows: a candidate stays while its bounds meet a window that does
not already have enough surely better ones.

Candidates are dealt into shards of bounded bytes by id, so a label or a group of
copies that holds a third of all rows is spread over all of them, and anchors into
parts that each meet a copy of every shard.  All anchors against all rows is a
quadratic amount of work by its definition; its tasks are of bounded size.  The best
of each shard, a fixed number per window, are merged by a ranked window.

Defined results.  Components are ``floor(256 * x)``.  Rows with a null label, id or
vector, an empty vector, or a null or non-finite component take no part; nor do those
with a component above 65,536 in size, whose scores a long may not hold.  Of rows with
the same id the one with the smallest vector, then the smallest label, takes part.
Vectors of different widths are never compared.  Equal scores are ranked by id.  An
anchor without another row of its label, and a positive whose window holds nothing
(always so below zero), have no rows.  Columns other than ``vec_id``, ``embedding`` and
``label`` are ignored and may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .vectors import LARGEST, by_width, finite, one_per_id, representable, runs, whole

#: Positives per anchor, negatives per positive, and the window in hundredths of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Bytes of a shard's columns, anchors that meet a copy of it, and the fewest shards, so
#: that a small table is spread as well.  Results do not depend on them.
SHARD_BYTES, PART_ANCHORS, LEAST_SHARDS = 16 << 20, 65_536, 16
#: Dimensions read between two looks at the bounds.
STEP = 16


class Columns:
    """Candidates of one width, a column per dimension, ordered by label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        largest = int(np.abs(vectors).max()) if vectors.size else 0
        # Doubles add up whole numbers exactly below 2^53.
        exact = vectors.shape[1] * largest * LARGEST < 1 << 53
        self.columns = np.ascontiguousarray(vectors[order].T.astype(np.float64 if exact else np.int64))
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)
        self.read = 0

    def _scan(self, anchor: np.ndarray, alive: np.ndarray, may_stay) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the candidates that ``may_stay(lower, upper)`` to the end."""
        anchor = anchor.astype(self.columns.dtype)
        order = np.argsort(-np.abs(anchor), kind="stable")
        a = anchor[order]
        ends = np.stack([a * self.least[order], a * self.most[order]])
        # What the dimensions from each place on can add, at worst and at best.
        worst = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        best = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        partial = np.zeros(len(alive), dtype=self.columns.dtype)
        for at in range(0, len(a), STEP):
            if not len(alive):
                break
            dims = order[at:at + STEP]
            partial = partial + a[at:at + STEP] @ self.columns[dims[:, None], alive]
            self.read += len(alive) * len(dims)
            upto = min(at + STEP, len(a))
            kept = may_stay(partial + worst[upto], partial + best[upto])
            alive, partial = alive[kept], partial[kept]
        return alive, partial.astype(np.int64)

    def _ranked(self, places: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
        top = np.lexsort((self.ids[places], -scores))[:k]
        return list(zip(self.ids[places[top]].tolist(), scores[top].tolist()))

    def positives(self, anchor: np.ndarray, own_id: int, label: int, k: int) -> list[tuple[int, int]]:
        """The best k others of the same label as ``(id, score)``."""
        low, high = np.searchsorted(self.labels, [label, label + 1])
        alive = np.arange(low, high)
        alive = alive[self.ids[low:high] != own_id]

        def may_stay(lower, upper):
            return upper >= (np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else lower.min())

        return self._ranked(*self._scan(anchor, alive, may_stay), k)

    def negatives(
        self, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], k: int
    ) -> list[list[tuple[int, int]]]:
        """For each window, both ends included, the best k of other labels with a score in it."""
        low, high = np.searchsorted(self.labels, [label, label + 1])
        alive = np.concatenate([np.arange(low), np.arange(high, len(self.ids))])

        def may_stay(lower, upper):
            kept = np.zeros(len(lower), dtype=bool)
            for least, most in windows:
                sure = lower[(lower >= least) & (upper <= most)]
                enough = max(least, np.partition(sure, len(sure) - k)[len(sure) - k]) if len(sure) > k else least
                kept |= (upper >= enough) & (lower <= most)
            return kept

        places, scores = self._scan(anchor, alive, may_stay)
        return [
            self._ranked(places[inside], scores[inside], k)
            for least, most in windows for inside in [(scores >= least) & (scores <= most)]
        ]


def _blocks(pieces: list[pa.RecordBatch]) -> dict[int, Columns]:
    """The candidates of a shard by the width of their vectors."""
    held: dict[int, list] = {}
    for piece in pieces:
        ids = piece.column("vec_id").to_numpy()
        labels = piece.column("label").to_numpy()
        for places, x in by_width(piece.column("v")):
            held.setdefault(x.shape[1], []).append((ids[places], labels[places], x))
    return {w: Columns(*(np.concatenate(part) for part in zip(*parts))) for w, parts in held.items()}


def _scan_shards(kept: DataFrame, anchors: DataFrame, n_shards: int, n_parts: int, answer, schema: str) -> DataFrame:
    """``answer(columns, anchor row)`` for every anchor and every shard with vectors of its width.

    ``anchors`` has the columns of ``kept`` and what ``answer`` reads beside them.
    """
    extra = [c for c in anchors.columns if c not in kept.columns]
    kinds = dict(anchors.dtypes)
    parts = F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))
    shards = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    candidates = kept.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).cast("int").alias("shard"), parts.alias("part"),
        F.lit(0).alias("kind"), "*", *[F.lit(None).cast(kinds[c]).alias(c) for c in extra],
    )
    asked = anchors.select(
        shards.alias("shard"), F.pmod(F.xxhash64("vec_id"), F.lit(n_parts)).cast("int").alias("part"),
        F.lit(1).alias("kind"), *kept.columns, *extra,
    )
    tasks = candidates.unionByName(asked).repartition(n_shards * n_parts, "shard", "part")
    tasks = tasks.sortWithinPartitions("shard", "part", "kind")

    def scan(batches):
        task, held, blocks = None, [], None
        for batch in batches:
            out = []
            for (shard, part, kind), piece in runs(batch, ("shard", "part", "kind")):
                if (shard, part) != task:
                    task, held, blocks = (shard, part), [], None
                if kind == 0:
                    held.append(piece)
                    continue
                if blocks is None:
                    blocks, held = _blocks(held), []
                for row in piece.select(["vec_id", "v", "label", *extra]).to_pylist():
                    if len(row["v"]) in blocks:
                        row["v"] = np.array(row["v"], dtype=np.int64)
                        out += answer(blocks[len(row["v"])], row)
            yield pa.RecordBatch.from_pylist(out, schema=layout)

    layout = pa.schema([(name, pa.int64()) for name in (f.split()[0] for f in schema.split(", "))])
    return tasks.mapInArrow(scan, schema)


def mine(
    rows: DataFrame, is_anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``rows``
    (``vec_id, embedding, label``) for the anchors, which ``is_anchor``, a condition on
    ``vec_id``, selects."""
    usable = rows.filter(F.col("label").isNotNull() & finite("embedding") & representable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole("embedding").alias("v"), F.col("label").cast("long").alias("label")
    )
    kept = materialize(one_per_id(usable, "label"), "whole-vectors")
    anchors = kept.filter(is_anchor)
    size = kept.agg(F.sum(F.size("v").cast("long")) * 8, F.count_if(is_anchor)).first()
    n_shards = max(LEAST_SHARDS, -(-(size[0] or 0) // SHARD_BYTES))
    n_parts = max(1, -(-size[1] // PART_ANCHORS))

    def closest(columns, row):
        return [
            {"anchor_id": row["vec_id"], "positive_id": i, "positive_score": s}
            for i, s in columns.positives(row["v"], row["vec_id"], row["label"], n_positives)
        ]

    found = _scan_shards(
        kept, anchors, n_shards, n_parts, closest, "anchor_id long, positive_id long, positive_score long"
    )
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= n_positives)
    positives = materialize(best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("own")  # a few per anchor
    ), "positives")

    def resolve(columns, row):
        open_ones = [
            (p["positive_id"], p["positive_score"], (-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100))
            for p in row["own"]
        ]
        open_ones = [o for o in open_ones if o[2][0] <= o[2][1]]
        if not open_ones:
            return []
        inside = columns.negatives(row["v"], row["label"], [o[2] for o in open_ones], n_negatives)
        return [
            {"anchor_id": row["vec_id"], "positive_id": p, "positive_score": ps, "negative_id": i, "negative_score": s}
            for (p, ps, _), found in zip(open_ones, inside) for i, s in found
        ]

    mined = _scan_shards(
        kept, anchors.join(positives, "vec_id"), n_shards, n_parts, resolve,
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return mined.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

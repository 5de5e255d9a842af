"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree grows level by level.  A pass over the table counts the rows of every open
node; a node with more rows than a leaf should hold is split by k-means into
``BRANCHES`` children, fitted on a sample of about ``FIT_ROWS`` of its rows, all nodes of
a level side by side.  Leaves hold about twice the square root of the number of rows, so
that queries visit and read about as much of a larger table as leaves are more; there
are at most ``LEVELS`` levels and ``TREE_BYTES`` of centroids, which is what a task and a
broadcast hold.  Every row is indexed: it goes down to the nearest child at each level
and belongs to one leaf.

A query goes through the tree best bin first (Muja and Lowe 2009): it descends to the
nearest child, leaves the siblings in a priority queue by distance, and takes the
nearest node of the queue next, until it has seen as many leaves as asked and as many
rows as it must return.  How many leaves that is comes from calibration: for a bounded
number of queries the true neighbours are found by brute force over all rows, and the
visits are widened, by a quarter at a time, until the leaves visited hold a share
``TARGET`` of them.
The target lies above the recall promised, 0.9, by more than the sampling error.

The rows of a visited leaf and the queries that visit it meet in tasks of bounded size:
a leaf with many rows or many visits is dealt into parts by id.  Distances there are
computed on the original vectors in double precision.  Each task gives k rows per query
and part, which a ranked window merges, cut before they are shuffled.

Defined results.  Rows with a null id or vector, an empty or zero vector, or a null or
non-finite component take no part.  Of rows with the same id the one with the smallest
vector takes part.  Vectors of different widths have trees of their own and are never
compared.  Equal distances are ranked by id.  A query with fewer than k candidates gets
them all; one without gets no rows.  Columns other than ``vec_id`` and ``embedding`` are
ignored and may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .vectors import by_width, finite, one_per_id, runs

TOP = 10
#: Children of a node, rows that are never split, rows of the sample that splits a node,
#: rounds of its k-means, and the most levels and bytes of centroids of a tree.
BRANCHES, LEAF_ROWS, FIT_ROWS, FIT_ROUNDS, LEVELS, TREE_BYTES = 16, 256, 2048, 8, 5, 32 << 20
#: Queries that are also answered by brute force, and the share of true neighbours to reach.
CALIBRATION, TARGET = 200, 0.95
#: Rows of a leaf, and visits of it, that meet in one group.
PART_ROWS, PART_VISITS = 8192, 65_536


@dataclass
class Node:
    """A node of a tree; a leaf has no children and holds ``rows`` rows."""

    centroids: np.ndarray | None = None
    children: list[int] | None = None
    rows: int = 0


class Forest:
    """A tree for each width of vectors; node numbers are shared."""

    def __init__(self, widths: list[int]):
        self.nodes = [Node() for _ in widths]
        self.root = {w: i for i, w in enumerate(widths)}

    def split(self, node: int, centroids: np.ndarray) -> None:
        first = len(self.nodes)
        self.nodes[node] = Node(centroids, list(range(first, first + len(centroids))))
        self.nodes += [Node() for _ in centroids]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``x``."""
        at = np.full(len(x), self.root[x.shape[1]])
        open_ones = {self.root[x.shape[1]]: np.arange(len(x))}
        while open_ones:
            node, rows = open_ones.popitem()
            if (split := self.nodes[node]).children is None:
                at[rows] = node
                continue
            nearest = _gaps(x[rows], split.centroids).argmin(axis=1)
            for child in np.unique(nearest):
                open_ones[split.children[child]] = rows[nearest == child]
        return at

    def leaves(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, self.root[len(q)])]
        while queue:
            node = heapq.heappop(queue)[1]
            while (split := self.nodes[node]).children is not None:
                gaps = ((split.centroids - q) ** 2).sum(axis=1)
                nearest = int(gaps.argmin())
                for i, child in enumerate(split.children):
                    if i != nearest:
                        heapq.heappush(queue, (float(gaps[i]), child))
                node = split.children[nearest]
            yield node

    def visits(self, q: np.ndarray, n_leaves: int, n_rows: int) -> list[int]:
        """The first ``n_leaves`` leaves, and more until they hold ``n_rows`` rows."""
        seen, held = [], 0
        for leaf in self.leaves(q):
            if len(seen) >= n_leaves and held >= n_rows:
                break
            if self.nodes[leaf].rows:
                seen.append(leaf)
                held += self.nodes[leaf].rows
        return seen

    def bytes(self) -> int:
        return sum(n.centroids.nbytes for n in self.nodes if n.centroids is not None)


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances up to rounding, by one matrix product."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T), 0)


def kmeans(x: np.ndarray, k: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Up to k centroids of ``x``: a farthest-point start weighted by chance, then Lloyd's rounds."""
    rng = np.random.RandomState(len(x))
    centroids, gap = x[:1], _gaps(x, x[:1])[:, 0]
    while len(centroids) < k and gap.max() > 1e-12:
        new = x[rng.choice(len(x), p=gap / gap.sum())][None]
        centroids, gap = np.concatenate([centroids, new]), np.minimum(gap, _gaps(x, new)[:, 0])
    for _ in range(rounds):
        nearest = _gaps(x, centroids).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        centroids = sums[sizes > 0] / sizes[sizes > 0, None]
    return centroids


def _vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    usable = rows.filter(finite("embedding") & F.exists("embedding", lambda x: x != 0))
    return one_per_id(usable.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    ))


def _placed(kept: DataFrame, forest: Forest) -> DataFrame:
    """``kept`` with the leaf of every row."""
    def place(batches):
        for batch in batches:
            leaf = np.zeros(batch.num_rows, dtype=np.int32)
            for at, x in by_width(batch.column(1)):
                leaf[at] = forest.place(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], names=["vec_id", "v", "leaf"])

    return kept.mapInArrow(place, "vec_id long, v array<double>, leaf int")


def grow(kept: DataFrame) -> Forest:
    """The trees of all widths, with the number of rows of every leaf."""
    forest = Forest([r[0] for r in kept.select(F.size("v")).distinct().orderBy(F.size("v")).collect()])
    open_ones = set(range(len(forest.nodes)))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(frame.sort_values("vec_id")["v"].to_list())
        made = kmeans(x, BRANCHES)
        return pd.DataFrame({"leaf": frame["leaf"].iloc[0], "centroid": list(made)})

    for level in range(LEVELS + 1):
        placed = _placed(kept, forest)
        counts = {r[0]: r[1] for r in placed.groupBy("leaf").agg(F.count("*")).collect()}  # nodes, of bounded number
        for node in open_ones:
            forest.nodes[node].rows = counts.get(node, 0)
        if not level:
            limit = max(LEAF_ROWS, 2 * math.isqrt(sum(counts.values())))
        large = {n: counts[n] for n in open_ones if counts.get(n, 0) > limit}
        if not large or level == LEVELS or forest.bytes() >= TREE_BYTES:
            break
        share = F.element_at(F.create_map(*[F.lit(x) for n, c in large.items() for x in (n, min(1.0, FIT_ROWS / c))]), F.col("leaf"))
        chance = F.pmod(F.xxhash64("vec_id", F.lit(len(forest.nodes))), F.lit(1 << 30)) / (1 << 30)
        sample = placed.filter(F.col("leaf").isin(list(large))).filter(chance < share)
        children: dict[int, list] = {}
        for node, centroid in sample.groupBy("leaf").applyInPandas(fit, "leaf int, centroid array<double>").collect():
            children.setdefault(node, []).append(centroid)
        first = len(forest.nodes)
        for node in sorted(children):
            if len(children[node]) > 1:  # copies of one vector stay a leaf
                forest.split(node, np.array(sorted(children[node])))
        open_ones = set(range(first, len(forest.nodes)))
    return forest


def _top(ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row of ``q``: its place, and ids and distances of its k nearest rows of ``x``.

    A matrix product finds who can be among them, with a margin for its rounding; their
    distances are then computed from the differences.
    """
    gaps = _gaps(q, x)
    margin = 1e-9 * ((q * q).sum(axis=1) + (x * x).sum(axis=1).max())
    for i in range(len(q)):
        gap = np.where(ids == own[i], np.inf, gaps[i])
        limit = np.partition(gap, k - 1)[k - 1] if len(gap) > k else np.inf
        near = np.flatnonzero((gap <= limit + margin[i]) & (ids != own[i]))
        exact = np.sqrt(((x[near] - q[i]) ** 2).sum(axis=1))
        order = np.lexsort((ids[near], exact))[:k]
        yield i, ids[near][order], exact[order]


def _nearest(found: DataFrame, k: int) -> DataFrame:
    by_distance = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(by_distance)).filter(F.col("rank") <= k)


def brute_force(placed: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """``query_id, rank, vec_id, score, leaf``: the true neighbours of a bounded number of
    queries among all rows.  A task keeps its k best per query only."""
    asked: dict[int, list] = {}
    for i, q in queries:
        asked.setdefault(len(q), []).append((i, q))
    by_size = {w: (np.array([i for i, _ in own]), np.array([q for _, q in own])) for w, own in asked.items()}

    def search(batches):
        best: dict[int, list] = {}
        for batch in batches:
            ids, leaf = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for at, x in by_width(batch.column(1)):
                if x.shape[1] not in by_size:
                    continue
                own, q = by_size[x.shape[1]]
                leaf_of = dict(zip(ids[at].tolist(), leaf[at].tolist()))
                for i, near, score in _top(ids[at], x, q, own, k):
                    new = [(s, n, leaf_of[n]) for s, n in zip(score.tolist(), near.tolist())]
                    best[int(own[i])] = sorted(best.get(int(own[i]), []) + new)[:k]
        rows = [(i, n, s, leaf) for i, near in best.items() for s, n, leaf in near]
        yield pa.RecordBatch.from_pylist([dict(zip(layout.names, r)) for r in rows], schema=layout)

    layout = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("leaf", pa.int32())])
    return _nearest(placed.mapInArrow(search, "query_id long, vec_id long, score double, leaf int"), k)


def calibrate(placed: DataFrame, asked: DataFrame, forest: Forest, k: int, target: float = TARGET) -> tuple[int, float]:
    """Leaves to visit and the share of the true neighbours that they hold, for the
    queries with the smallest hashes, ``CALIBRATION`` of them."""
    chosen = [(r.vec_id, np.array(r.v)) for r in asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()]
    true: dict[int, list[int]] = {}
    for r in brute_force(placed, chosen, k).select("query_id", "leaf").collect():  # k rows per query
        true.setdefault(r.query_id, []).append(r.leaf)
    places = []
    for i, q in chosen:
        order = {leaf: n for n, leaf in enumerate(leaf for leaf in forest.leaves(q) if forest.nodes[leaf].rows)}
        places += [order[leaf] for leaf in true.get(i, [])]
    if not places:
        return 1, 1.0
    places, n_leaves = np.array(places), 1
    while (recall := float((places < n_leaves).mean())) < target:
        n_leaves += max(1, n_leaves // 4)
    return n_leaves, recall


def _search(placed: DataFrame, asked: DataFrame, forest: Forest, n_leaves: int, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the k nearest rows of every part of every visited leaf."""
    def visit(batches):
        for batch in batches:
            ids, out_ids, out_leaves = batch.column(0).to_numpy(), [], []
            for at, x in by_width(batch.column(1)):
                for i, q in zip(ids[at], x):
                    seen = forest.visits(q, n_leaves, k + 1)
                    out_ids += [i] * len(seen)
                    out_leaves += seen
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_ids, type=pa.int64()), pa.array(out_leaves, type=pa.int32())], names=["vec_id", "leaf"]
            )

    visits = materialize(asked.mapInArrow(visit, "vec_id long, leaf int"), "visits")
    # One row per leaf: how many parts its rows and its visits are dealt into.
    parts = {n: -(-node.rows // PART_ROWS) for n, node in enumerate(forest.nodes) if node.rows}
    turns = {r[0]: -(-r[1] // PART_VISITS) for r in visits.groupBy("leaf").agg(F.count("*")).collect()}
    table = F.broadcast(placed.sparkSession.createDataFrame(
        [(leaf, parts[leaf], n) for leaf, n in turns.items()], "leaf int, parts int, turns int"
    ))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = placed.join(table, "leaf").select(
        "leaf", dealt("parts").alias("part"), each("turns").alias("turn"), F.lit(0).alias("kind"), "vec_id", "v"
    )
    sent = visits.join(asked, "vec_id").join(table, "leaf").select(
        "leaf", each("parts").alias("part"), dealt("turns").alias("turn"), F.lit(1).alias("kind"), "vec_id", "v"
    )
    groups = rows.unionByName(sent).repartition("leaf", "part", "turn").sortWithinPartitions("leaf", "part", "turn", "kind", "vec_id")

    def search(batches):
        group, held, x = None, [], None
        for batch in batches:
            out_q, out_ids, out_scores = [], [], []
            for (leaf, part, turn, kind), piece in runs(batch, ("leaf", "part", "turn", "kind")):
                if (leaf, part, turn) != group:
                    group, held, x = (leaf, part, turn), [], None
                ids = piece.column("vec_id").to_numpy()
                (_, own), = by_width(piece.column("v"))
                if kind == 0:
                    held.append((ids, own))
                    continue
                if x is None:
                    x = [np.concatenate(p) for p in zip(*held)] if held else []
                if not x:
                    continue
                for start in range(0, len(own), 64):
                    for i, near, score in _top(*x, own[start:start + 64], ids[start:start + 64], k):
                        out_q.append(np.full(len(near), ids[start + i]))
                        out_ids.append(near)
                        out_scores.append(score)
            if out_q:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (out_q, out_ids, out_scores)], names=["query_id", "vec_id", "score"]
                )

    return groups.mapInArrow(search, "query_id long, vec_id long, score double")


def search(rows: DataFrame, is_query: Column, k: int = TOP, target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score, leaves, calibrated_recall``: the k nearest rows found
    for each of ``rows`` (``vec_id, embedding``) that ``is_query``, a condition on ``vec_id``, selects."""
    kept = materialize(_vectors(rows), "vectors")
    forest = grow(kept)
    placed = materialize(_placed(kept, forest), "placed")
    asked = kept.filter(is_query)
    n_leaves, recall = calibrate(placed, asked, forest, k, target)
    return _nearest(_search(placed, asked, forest, n_leaves, k), k).select(
        "query_id", "rank", "vec_id", "score", F.lit(n_leaves).alias("leaves"), F.lit(recall).alias("calibrated_recall")
    )

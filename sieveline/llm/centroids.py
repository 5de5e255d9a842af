"""Centroid clustering whose assignments are found by Orchard's search.

Every centroid has a list of all others by distance.  A vector starts at one
centroid and goes down that one's list; as soon as a listed centroid is closer it
jumps to the closer one's list, and it never measures a centroid twice.  It stops at
the first entry strictly farther from the centroid it is at than twice its own
distance: by the triangle inequality nothing behind can be closer or as close
(Orchard 1991).  All vectors of an Arrow batch walk side by side.

A round reads the vectors once; tasks add up their vectors by cluster, so a cluster
that holds a third of all rows costs no more than another.  Only the centroids and
their sums, k times the width, are held by the driver and sent to tasks.

Defined results.  Components are whole numbers, ``floor(256 * x)``, and distances are
squared; ties go to the smaller number.  Rows whose vector is null, has another width
or a null or non-finite component are left out, as are those with a component above
65,536 in size, whose distances a long may not hold.  Rows without ``vec_id`` are
assigned but start no centroid; repeated rows count each, and of equal hashes the
smaller vector comes first.  With fewer rows than k there are as many centroids as
rows.  Columns other than ``vec_id`` and ``embedding`` are ignored and may have any
name.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .vectors import by_width, finite, representable, whole

#: Centroids, rounds of moving them, width of the vectors, and what is hashed before an id.
K, ROUNDS, WIDTH, SALT = 40, 5, 64, "2:"

_ASSIGNED = "vec_id long, cluster int, distance long"


class Orchard:
    """Centroids with a list of neighbours each."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        gap = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        self.list = np.argsort(gap, axis=1, kind="stable")
        # A quarter of the squared distances, rounded up: gap > 4 d is the same as quarter > d.
        self.quarter = -(-np.take_along_axis(gap, self.list, axis=1) // 4)
        self.start = int(gap.sum(axis=1, dtype=float).argmin())
        self.measured = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the centroid nearest to each row of ``x``."""
        k, n = len(self.centroids), len(x)
        at = np.full(n, self.start)
        best = ((x - self.centroids[self.start]) ** 2).sum(axis=1)
        visited = np.zeros((n, k), dtype=bool)
        visited[:, self.start] = True
        place = np.zeros(n, dtype=np.int64)
        self.measured += n
        going = np.arange(n)
        while len(going):
            within = self.quarter[at[going], place[going]] <= best[going]
            going = going[within]
            listed = self.list[at[going], place[going]]
            place[going] += 1
            new = ~visited[going, listed]
            asked, other = going[new], listed[new]
            visited[asked, other] = True
            distance = ((x[asked] - self.centroids[other]) ** 2).sum(axis=1)
            self.measured += len(asked)
            closer = (distance < best[asked]) | ((distance == best[asked]) & (other < at[asked]))
            jumping = asked[closer]
            at[jumping], best[jumping], place[jumping] = other[closer], distance[closer], 0
            going = going[place[going] < k]
        return at, best


def _start(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors whose salted ids have the smallest hashes, in their order."""
    hashed = kept.filter("vec_id IS NOT NULL").select(
        F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).alias("hash"), "v"
    )
    return np.array([r.v for r in hashed.orderBy("hash", "v").limit(k).collect()], dtype=np.int64)


def _sums(kept: DataFrame, index: Orchard) -> dict[int, tuple[int, list[int]]]:
    """Size and componentwise sum of every non-empty cluster, exact."""
    k, width = index.centroids.shape

    def add(batches):
        sizes, total = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=np.int64)
        for batch in batches:
            for _, x in by_width(batch.column(0)):
                at, _ = index.nearest(x)
                sizes += np.bincount(at, minlength=k)
                order = np.argsort(at, kind="stable")
                first = np.flatnonzero(np.diff(at[order], prepend=-1))
                total[at[order][first]] += np.add.reduceat(x[order], first, axis=0)
        own = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.astype(np.int32)), pa.array(sizes[own]), pa.array(total[own].tolist(), type=pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = kept.select("v").mapInArrow(add, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "s"))
    added = each.groupBy("cluster", "pos").agg(F.sum("n"), F.sum(F.col("s").cast("decimal(38,0)")))
    made: dict[int, tuple[int, list[int]]] = {}
    for c, pos, n, s in added.collect():  # k times width rows
        made.setdefault(c, (n, [0] * width))[1][pos] = int(s)
    return made


def cluster(rows: DataFrame, k: int = K, rounds: int = ROUNDS, width: int = WIDTH, salt: str = SALT) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector."""
    kept = materialize(
        rows.filter(finite("embedding") & (F.size("embedding") == width) & representable("embedding"))
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole("embedding").alias("v")), "whole-vectors",
    )
    start = _start(kept, k, salt)
    if not len(start):
        return kept.sparkSession.createDataFrame(
            [], f"{_ASSIGNED}, cluster_inertia long, inertia long, centroid array<long>"
        )
    index = Orchard(start)
    for _ in range(rounds):
        moved = index.centroids.copy()
        for c, (n, sums) in _sums(kept, index).items():
            moved[c] = [s // n for s in sums]
        index = Orchard(moved)

    def assign(batches):
        for batch in batches:
            at, best = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for places, x in by_width(batch.column(1)):
                at[places], best[places] = index.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"]
            )

    assigned = materialize(kept.mapInArrow(assign, _ASSIGNED), "clusters")
    spread = [(r[0], r[1]) for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()]  # k rows
    table = kept.sparkSession.createDataFrame(
        [(c, s, sum(s for _, s in spread), index.centroids[c].tolist()) for c, s in spread],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )

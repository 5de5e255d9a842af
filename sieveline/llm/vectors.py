"""Rows of an embedding table that take part in searches, and their arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole components are at most this large, so that sums of squares of up to 4,096
#: differences fit into a long.
LARGEST = 1 << 24


def finite(vector: str) -> Column:
    """Neither the vector nor a component is null, and no component is NaN or infinite."""
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


def whole(vector: str) -> Column:
    """``floor(256 * x)`` of every component, with x as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256))


def representable(vector: str) -> Column:
    """The whole components are no larger than :data:`LARGEST`."""
    return F.forall(vector, lambda x: F.abs(x.cast("double")) <= LARGEST // 256)


def one_per_id(rows: DataFrame, *extra: str) -> DataFrame:
    """Of rows with the same ``vec_id`` the one with the smallest vector, then the
    smallest ``extra`` columns; rows without an id are left out."""
    packed = F.min(F.struct("v", *extra)).alias("kept")
    return rows.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(packed).select("vec_id", "kept.*")


def by_width(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a batch as ``(their places, matrix)``, one pair per length."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    widths = np.diff(ends)
    made = []
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        made.append((at, values[ends[at][:, None] + np.arange(width)]))
    return made


def runs(batch: pa.RecordBatch, names: tuple[str, ...]) -> list[tuple[tuple, pa.RecordBatch]]:
    """Pieces of a batch whose rows agree in the named integer columns, in order."""
    if not batch.num_rows:
        return []
    keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
    first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
    ends = np.append(first[1:], batch.num_rows)
    return [(tuple(int(x) for x in keys[:, i]), batch.slice(i, j - i)) for i, j in zip(first, ends)]

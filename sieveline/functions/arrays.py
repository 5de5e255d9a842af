"""Helpers on array columns that keep per-row work inside one projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it.

    Inside a lambda an expression is evaluated anew for every element, so a
    sorted array or a norm must be bound before a lambda refers to it.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def run_lengths(values: Column) -> Column:
    """Distinct elements of an array with their counts, ascending.

    Returns ``array<struct<value, n>>``: sort, find where each run starts, and
    subtract neighbouring starts, so the cost is one sort per row.
    """
    def runs(a: Column) -> Column:
        starts = F.filter(
            F.transform(a, lambda v, i: F.when((i == 0) | (v != F.get(a, i - 1)), i)),
            lambda i: i.isNotNull(),
        )

        def measure(s: Column) -> Column:
            return F.transform(
                s,
                lambda at, k: F.struct(
                    F.get(a, at).alias("value"),
                    (F.coalesce(F.get(s, k + 1), F.size(a)) - at).alias("n"),
                ),
            )

        return bind(starts, measure)

    return bind(F.sort_array(values), runs)


def total(values: Column) -> Column:
    """Sum of an ``array<double>``, left to right; 0 for an empty array."""
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def laid_out(entries: Column, size: Column, empty: Column) -> Column:
    """An array of ``size`` elements from ``array<struct<at, value>>`` ascending by ``at``, with
    ``empty`` where no entry is: each entry is put behind the gap before it, so the work is
    that of writing the array once."""
    def fill(e: Column) -> Column:
        before = lambda i: F.coalesce(F.get(e, i - 1).at, F.lit(-1))
        pieces = F.transform(e, lambda x, i: F.concat(
            F.array_repeat(empty, F.greatest(x.at - before(i) - 1, F.lit(0)).cast("int")), F.array(x.value)
        ))
        last = F.coalesce(F.get(e, F.size(e) - 1).at, F.lit(-1))
        return F.concat(F.flatten(pieces), F.array_repeat(empty, F.greatest(size - last - 1, F.lit(0)).cast("int")))

    return bind(entries, fill)

"""Cutting ordered rows into fixed-size batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

#: Rows of one numbering bucket, fewer if that leaves cores idle, and the number
#: of buckets that may be broadcast (three numbers each: a few megabytes).  These and
#: the limits below decide the way rows are numbered, never the numbers.
BUCKET_WIDTH = 1 << 16
MAX_BUCKETS = 50_000
#: Files whose batch counts may be broadcast; beyond it the join shuffles.
MAX_FILES = 500_000
#: Widest bucket one sort may be asked to hold.
MAX_BUCKET_WIDTH = 1 << 22


def prefix_sum(
    df: DataFrame,
    order: str,
    values: dict[str, str],
    keys: Sequence[str] = (),
    span: int | None = None,
    block: int = 4096,
) -> DataFrame:
    """Inclusive running sums, ``{value column: output column}``, by integer ``order``.

    A single window would put every row of a key into one task.  Unless ``span``
    says the order column stays below one block, sums run inside blocks and the
    few block totals are summed on top.
    """
    def running(window_keys: Sequence[str], by: str, upto: int):
        # A literal partition only names the single group of an unkeyed sum.
        groups = list(window_keys) or [F.lit(0)]
        return Window.partitionBy(*groups).orderBy(by).rowsBetween(Window.unboundedPreceding, upto)

    if span is not None and span <= block:
        w = running(keys, order, Window.currentRow)
        return df.withColumns({out: F.sum(v).over(w) for v, out in values.items()})

    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    totals = blocked.groupBy(*keys, "_block").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    before = running(keys, "_block", -1)
    offsets = totals.select(
        *keys, "_block",
        *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values],
    )
    inside = running([*keys, "_block"], order, Window.currentRow)
    return (
        blocked.withColumns({out: F.sum(v).over(inside) for v, out in values.items()})
        .join(offsets, [*keys, "_block"])
        .withColumns({out: F.col(out) + F.col(f"_{v}") for v, out in values.items()})
        .drop("_block", *[f"_{v}" for v in values])
    )


def number_rows(df: DataFrame, key: str, within: str | None = None) -> DataFrame:
    """Add ``row_no`` (from 0, by ascending ``key``) and ``n_rows``, per ``within`` if given.

    ``key`` must be a unique integer.  Rows are bucketed by key range, the small
    table of bucket counts is summed up, and rows are ranked inside their bucket,
    so no task sees more rows than a bucket is wide and the numbers come out the
    same on any recomputation.  Counting reads the key column only.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return df.withColumns({"row_no": F.lit(0).cast("long"), "n_rows": F.lit(0).cast("long")})
    extent = high - low + 1
    cores = df.sparkSession.sparkContext.defaultParallelism
    width = max(min(BUCKET_WIDTH, -(-extent // (4 * cores))), -(-extent // MAX_BUCKETS))
    if width > MAX_BUCKET_WIDTH:  # sparse keys: a dense stretch could overfill a bucket
        return number_rows_by_range(df, [key], within)

    keys = [within] if within else []
    bucketed = df.withColumn("_bucket", F.floor((F.col(key) - low) / width))
    counts = bucketed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket")
    everything = Window.partitionBy(*(keys or [F.lit(0)]))
    offsets = counts.select(
        *keys, "_bucket",
        (F.sum("_n").over(before) - F.col("_n")).alias("_first"),
        F.sum("_n").over(everything).alias("n_rows"),
    )
    if not within:
        offsets = F.broadcast(offsets)  # at most MAX_BUCKETS rows
    rank = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(key))
    return (
        bucketed.withColumn("_rank", rank)
        .join(offsets, [*keys, "_bucket"])
        .withColumn("row_no", F.col("_first") + F.col("_rank") - 1)
        .drop("_bucket", "_first", "_rank")
    )


def number_rows_by_range(
    df: DataFrame, order_by: Sequence[str], within: str | None = None
) -> DataFrame:
    """:func:`number_rows` for any unique ordering: several columns, any type.

    Rows are range-partitioned and sorted, then written to the checkpoint folder,
    because range bounds are sampled and would differ in a second evaluation.
    """
    shared_dir(df.sparkSession)
    order = [*([within] if within else []), *order_by]
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumns({
            "_part": F.shiftright("_place", 33),
            "_index": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)),
        })
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    before = Window.partitionBy(F.lit(0)).orderBy("_part")
    everything = Window.partitionBy(F.lit(0))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(before) - F.col("_n")).alias("_first"),
        F.sum("_n").over(everything).alias("n_rows"),
    )
    numbered = (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("row_no", F.col("_first") + F.col("_index"))
        .drop("_place", "_part", "_index", "_first")
    )
    if not within:
        return numbered
    starts = numbered.groupBy(within).agg(F.min("row_no").alias("_start"), F.count("*").alias("_size"))
    return (
        numbered.drop("n_rows").join(starts, within)
        .withColumn("row_no", F.col("row_no") - F.col("_start"))
        .withColumnRenamed("_size", "n_rows").drop("_start")
    )


def full_batches(n_rows, batch_size: int):
    """Batches cut from ``n_rows`` rows: the full ones, and a last short one only
    if it lacks exactly one row.  Any other remainder is dropped."""
    extra = F.when((n_rows % batch_size == batch_size - 1) & (F.lit(batch_size) > 1), 1).otherwise(0)
    return F.floor(n_rows / batch_size) + extra


def assign_batches(numbered: DataFrame, batch_size: int, keep_tail: bool = True) -> DataFrame:
    """Add ``batch_no`` (from 1) and ``row_in_batch`` (from 0).

    The rows left over make a short last batch; without ``keep_tail`` they are sent
    or dropped by the rule of :func:`full_batches`.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    batched = numbered.withColumns({
        "batch_no": F.floor(F.col("row_no") / batch_size) + 1,
        "row_in_batch": (F.col("row_no") % batch_size).cast("int"),
    })
    return batched if keep_tail else batched.filter(F.col("batch_no") <= full_batches(F.col("n_rows"), batch_size))


def batch_table(df: DataFrame, key: str, batch_size: int, keep_tail: bool = True) -> DataFrame:
    """Batches of a table ordered by a unique integer key."""
    return assign_batches(number_rows(df, key), batch_size, keep_tail)


def replay_files(df: DataFrame, file_no: str, key: str, batch_size: int) -> DataFrame:
    """Batches of several files one after another; no batch spans two files."""
    per_file = df.groupBy(file_no).agg(full_batches(F.count("*"), batch_size).alias("_batches"))
    earlier = prefix_sum(per_file, file_no, {"_batches": "_upto"}).select(
        file_no, (F.col("_upto") - F.col("_batches")).alias("_earlier")
    )
    if df.select(file_no).distinct().count() <= MAX_FILES:
        earlier = F.broadcast(earlier)  # two numbers per file
    return (
        assign_batches(number_rows(df, key, within=file_no), batch_size, keep_tail=False)
        .join(earlier, file_no)
        .withColumn("file_batch_no", F.col("batch_no"))
        .withColumn("batch_no", F.col("batch_no") + F.col("_earlier"))
        .drop("_earlier")
    )


def replay_epochs(batched: DataFrame, batch_size: int, epochs: int) -> DataFrame:
    """The whole batched table, cut by the tail rule, ``epochs`` times over, batch
    numbers running on; ``epochs`` is at least 1."""
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    return batched.withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    ).withColumn(
        "batch_no", F.col("epoch") * full_batches(F.col("n_rows"), batch_size) + F.col("batch_no")
    )

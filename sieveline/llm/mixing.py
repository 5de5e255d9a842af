"""Mixing sources to target weights by entropy balancing.

Every source gets a target of words.  Document rates are the ones closest to 1 in
relative entropy that meet the targets: with ``c`` the size of a document over the
mean size of its source, the dual of that problem is convex in one multiplier per
source, and the rates are ``exp(multiplier * c)``, up to the largest rate allowed.
Newton steps on the dual run for all sources at once, over one row per source and
size.  The rates are then rounded into whole copies along the sizes of a source, so
that the words taken differ from the target by less than one long document, and a
few single copies are moved to close what is left.

Defined results.  A null or empty text has size 0 and rate 1.  Sources are ordered
by code point, a null source last.  Rows with the same id are documents of their
own; identical rows are interchangeable.  Columns other than ``doc_id, text,
source`` are ignored and may have any name.  An empty table gives an empty result,
and a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.batching import number_rows_by_range
from ..session import materialize, shared_dir

#: Contract: weights of the sources in turn, share of all words to take, largest rate.
WEIGHTS, BUDGET, LARGEST = (3.0, 1.0, 2.0), 1.5, 2.0
#: Newton steps at most, and the relative miss of a target at which they stop.
STEPS, CLOSE = 60, 1e-7
#: Documents of one source and size that are ranked together.
RANKED = 8192
#: Rounds in which single copies are moved.
MOVES = 3
#: Sources whose few numbers and name travel to all tasks.
MAX_SENT_SOURCES = 100_000


def document_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, source, size``: words are runs of non-blank characters."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.col("source").cast("string").alias("source"), size.alias("size"),
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, largest: float = LARGEST) -> DataFrame:
    """``src, source, source_size, n, target``: one row per source, ``src`` from 0.

    The budget is shared by weight; what a source cannot take goes to the others
    by weight.  The level of words per weight rises until that settles.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = sources.withColumn("none", F.col("source").isNull())
    sources = number_rows_by_range(sources, ["none", "source"]).withColumnRenamed("row_no", "src")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    sources = materialize(sources.select("src", "source", "source_size", "n", turn.alias("weight")), "sources")
    limit = F.col("source_size") * largest
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, None
    while True:
        above = F.col("weight") * level > limit
        stats = sources.agg(
            F.sum(F.when(above, limit)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("full"),
        ).first()
        if stats.open is None or stats.full == full:
            break
        full, level = stats.full, (budget * total - (stats.held or 0.0)) / stats.open
    return sources.withColumn("target", F.least(F.col("weight") * level, limit))


def _rate(multiplier, c, largest: float):
    return F.when(multiplier.isNull(), F.lit(largest)).otherwise(F.least(F.exp(multiplier * c), F.lit(largest)))


def multipliers(cells: DataFrame, sources: DataFrame, largest: float = LARGEST) -> DataFrame:
    """``src, multiplier`` from Newton steps on the dual; null where every document
    is taken at the largest rate.

    ``cells`` has ``src, size, n``.  A step sums the words taken at the current
    rates and their derivative per source; a step that leaves the interval known
    to hold the root halves it instead.
    """
    spark = cells.sparkSession
    shared_dir(spark)
    shape = cells.filter("size > 0").groupBy("src").agg(F.min("size").alias("least"))
    state = sources.filter(F.col("source_size") > 0).join(shape, "src")
    ratio = F.col("target") / F.col("source_size")
    state = state.withColumn("mean", F.col("source_size") / F.col("n")).select(
        "src", "target", "mean", (ratio >= largest).alias("all"),
        F.least(F.lit(0.0), F.log(ratio) * F.col("mean") / F.col("least")).alias("low"),
        F.when(ratio <= 1, F.lit(0.0)).otherwise(F.log(F.lit(largest)) * F.col("mean") / F.col("least")).alias("high"),
        F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("miss"),
    ).checkpoint()
    own = cells.filter("size > 0").select("src", "size", F.col("n").cast("double").alias("n"))
    for _ in range(STEPS):
        c = F.col("size") / F.col("mean")
        rate = _rate(F.col("multiplier"), c, largest)
        words = F.col("n") * F.col("size")
        slope = F.when(rate < largest, words * rate * c).otherwise(0.0)
        summed = own.join(state.filter(~F.col("all")), "src").groupBy("src").agg(
            # decimals add up to the same whatever the order, so reruns agree to the last digit
            F.sum((words * rate).cast("decimal(38,9)")).cast("double").alias("taken"),
            F.sum(slope.cast("decimal(38,9)")).cast("double").alias("slope"),
        )
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - gap / F.nullif(F.col("slope"), F.lit(0.0))
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
        miss = F.abs(gap) / F.col("target")
        state = state.join(summed, "src", "left").select(
            "src", "target", "mean", "all", low.alias("low"), high.alias("high"),
            F.when(F.col("taken").isNull() | (miss < CLOSE), F.col("multiplier"))
            .when(inside, newton).otherwise((low + high) / 2).alias("multiplier"),
            miss.alias("miss"),
        ).checkpoint()
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst < CLOSE:
            break
    return state.select("src", "mean", F.when(~F.col("all"), F.col("multiplier")).alias("multiplier"))


def _rounded(rows: DataFrame, cells: DataFrame, largest: float) -> DataFrame:
    """Whole copies: along the sizes of a source, copies follow the running sum of
    rates, so a document gets its rate rounded down or up."""
    parts = F.ceil(F.col("n") / RANKED)
    key = F.xxhash64("doc_id", "text_key")
    placed = rows.join(cells, ["src", "size"]).withColumn("part", F.pmod(key, parts)).withColumn("order", key)
    pieces = placed.groupBy("src", "size", "part", "rate").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("src").orderBy("size", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "src", "size", "part", F.coalesce(F.sum(F.col("rows") * F.col("rate")).over(before), F.lit(0.0)).alias("start")
    )
    ranked = placed.withColumn("rank", F.row_number().over(
        Window.partitionBy("src", "size", "part").orderBy("order", "doc_id", "text_key")
    ))
    upto = F.floor(F.col("start") + F.col("rate") * F.col("rank") + 0.5)
    below = F.floor(F.col("start") + F.col("rate") * (F.col("rank") - 1) + 0.5)
    return ranked.join(starts, ["src", "size", "part"]).select(
        "doc_id", "text_key", "src", "size", "part", "rank", "rate",
        F.least(upto - below, F.lit(int(largest))).cast("long").alias("copies"),
    )


def _sent(by_source: DataFrame) -> DataFrame:
    """A hint for a table of a row per source, if they are few: documents of a source
    that holds a third of all then need not meet in one task."""
    return F.broadcast(by_source) if by_source.count() <= MAX_SENT_SOURCES else by_source


def _move(plan: DataFrame, sources: DataFrame, largest: float) -> DataFrame:
    """One copy more or less of the document that brings each source closest to its target."""
    taken = plan.groupBy("src").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
    gaps = _sent(materialize(
        sources.join(taken, "src").select("src", (F.col("target") - F.col("taken")).alias("gap")), "gaps"
    ))
    gap, size = F.col("gap"), F.col("size")
    may = ((gap > 0) & (F.col("copies") < int(largest))) | ((gap < 0) & (F.col("copies") > 0))
    closer = F.abs(F.abs(gap) - size)
    best = plan.join(gaps, "src").filter(may & (size > 0) & (closer < F.abs(gap))).groupBy("src").agg(
        F.min(F.struct(closer.alias("closer"), "size", "part", "rank", F.signum(gap).cast("long").alias("move"))).alias("m")
    ).select("src", "m.size", "m.part", "m.rank", "m.move")
    return plan.join(best, ["src", "size", "part", "rank"], "left").withColumn(
        "copies", F.col("copies") + F.coalesce("move", F.lit(0))
    ).drop("move")


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, largest: float = LARGEST) -> DataFrame:
    """``doc_id, text_key, source, size, source_size, target, rate, copies, taken``."""
    sizes = materialize(document_sizes(docs), "sizes")
    sources = materialize(source_targets(sizes, weights, budget, largest), "targets")
    named = _sent(sources)
    same = sizes["source"].eqNullSafe(named["source"])
    rows = materialize(sizes.join(named, same).select(sizes["doc_id"], "text_key", "src", "size"), "rows")
    cells = materialize(rows.groupBy("src", "size").agg(F.count("*").alias("n")), "cells")
    solved = multipliers(cells, sources, largest)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        _rate(F.col("multiplier"), F.col("size") / F.col("mean"), largest)
    )
    rated = cells.join(solved, "src", "left").select("src", "size", "n", rate.alias("rate"))
    plan = materialize(_rounded(rows, rated, largest), "copies")
    for _ in range(MOVES):
        plan = materialize(_move(plan, sources, largest), "copies")
    return plan.join(named.select("src", "source", "source_size", "target"), "src").select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def repeat(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, largest: float = LARGEST) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, or not at all.

    Identical rows share their copies.
    """
    plan = mix(docs, weights, budget, largest)
    copies = plan.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("source").alias("_source")).agg(
        F.sum("copies").alias("_copies")
    ).filter("_copies > 0")
    # The rows go along packed, so that their columns may have any name.
    rows = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), F.col("source").cast("string").alias("source"),
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
    )
    same = (
        rows["doc_id"].eqNullSafe(copies["_id"]) & (rows["key"] == copies["_key"])
        & rows["source"].eqNullSafe(copies["_source"])
    )
    once = rows.join(copies, same).dropDuplicates(["doc_id", "key", "source"])
    times = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    return once.select("row", times).select("row.*")

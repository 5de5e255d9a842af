"""Line dedup with levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first.  A batch's line hashes
are merge-anti-joined with the runs: hashes that no run has are new, and their
document, the largest that holds the line, keeps it.  The new hashes become a run
of level 0.  As soon as a level has FANOUT runs, they are merged into one run of the
next level, so a hash is rewritten only a logarithmic number of times and a batch
meets few runs.  Runs are bucketed and sorted by hash: a batch is shuffled once and
no run is ever shuffled again.  All of it is DataFrame operations.

A line's key is the line without blanks at both ends, A-Z lowered.  Keys of at least
MIN_CHARS code points in at least MIN_DOCS documents lose all lines except in the
largest ``doc_id`` that holds them.

Defined results.  A null or empty text is one empty line.  A null ``doc_id`` is a
document below all others, and its rows are one document; so are the rows that share
an id.  Each row of a repeated id keeps or loses lines by its own text.  Columns
other than ``doc_id`` and ``text`` are ignored and may have any name.  An empty
table gives an empty result.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import bind
from ..session import materialize, work_dir

#: Contract: shortest key, and the least number of documents.
MIN_CHARS, MIN_DOCS = 20, 3
#: Batches that a table is fed in, and runs of a level that are merged into one.
BATCHES, FANOUT = 4, 2

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lowered.  ``lower`` is right for
    ASCII alone; other lines are mapped letter by letter."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_key, pos, h1, h2``: 128-bit hashes of the keys that count."""
    lines = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), F.posexplode(text_lines(F.col("text"))).alias("pos", "line")
    ).filter(F.char_length("line") >= min_chars)
    keys = lines.select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key"))
    return keys.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


@dataclass
class Runs:
    """Sorted runs of ``h1, h2, keeper`` by level, kept as bucketed tables."""

    spark: SparkSession
    buckets: int
    fanout: int = FANOUT
    levels: list[list[tuple[str, str]]] = field(default_factory=list)

    def new_of(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose hash no run has; a merge with each run."""
        for name, _ in self._all():
            batch = batch.join(self.spark.table(name).select(*HASH).hint("merge"), HASH, "left_anti")
        return batch

    def add(self, rows: DataFrame) -> None:
        """Add new hashes as a run of level 0, and merge the levels that are full."""
        self._put(0, rows)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0][0])
            for name, _ in full[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self._put(level + 1, merged)
            for name, _ in full:
                self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def close(self) -> DataFrame:
        """All hashes with their keepers; the runs no longer take batches."""
        paths = [path for _, path in self._all()]
        for name, _ in self._all():
            self.spark.sql(f"DROP TABLE {name}")  # the files in the shared folder stay
        return self.spark.read.schema("h1 long, h2 long, keeper long").parquet(*paths)

    def _all(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def _put(self, level: int, rows: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name, path = f"run_{uuid.uuid4().hex}", work_dir(self.spark, f"run-level-{level}")
        (
            rows.repartition(self.buckets, "h1").write.bucketBy(self.buckets, "h1").sortBy(*HASH)
            .option("path", path).saveAsTable(name)
        )
        self.levels[level].append((name, path))


def _batch_no(doc_id: Column, low: int, high: int, batches: int) -> Column:
    """0 for the largest ids, rising; equal ranges of ids, null in the last.  Ids are
    compared with the ranges' ends, which is exact for all 64-bit numbers."""
    width = -(-(high - low + 1) // batches)
    ends = [end for end in (high - k * width for k in range(1, batches)) if end >= low]
    number = sum(((doc_id <= F.lit(end)).cast("int") for end in ends), F.lit(0))
    return F.when(doc_id.isNull(), batches - 1).otherwise(number)


def surplus_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``doc_id, text_key, pos`` of the lines to drop; a row of any place may repeat."""
    spark = docs.sparkSession
    ids = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = (0, 0) if ids.low is None else (ids.low, ids.high)
    batch = _batch_no(F.col("doc_id"), low, high, batches).alias("batch")
    path = work_dir(spark, "lines")
    line_hashes(docs, min_chars).select("*", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, text_key long, pos int, h1 long, h2 long, batch int").parquet(path)

    runs = Runs(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fanout)
    again = []
    for number in range(batches):
        keys = lines.filter(F.col("batch") == number).groupBy(*HASH).agg(
            F.max("doc_id").alias("keeper"),
            # documents with a null id count as one
            (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("n_docs"),
        )
        keys = materialize(keys, "batch-keys")
        new = materialize(runs.new_of(keys), "new-keys")
        runs.add(new.select(*HASH, "keeper"))
        # Documents of the batch, less the keeper if this batch has it.
        again += [keys.select(*HASH, "n_docs"), new.select(*HASH, F.lit(-1).cast("long").alias("n_docs"))]
    counts = again[0]
    for part in again[1:]:
        counts = counts.unionByName(part)
    others = counts.groupBy(*HASH).agg(F.sum("n_docs").alias("others")).filter(F.col("others") >= min_docs - 1)
    # Written first: as a plain table it lets the lines of one hash be split over tasks.
    common = materialize(others.select(*HASH).join(runs.close(), HASH), "common")
    return lines.join(common, HASH).filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select(
        "doc_id", "text_key", "pos"
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: every row's text without its surplus lines."""
    drops = surplus_lines(docs, min_chars, min_docs, batches, fanout)
    drops = drops.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_set("pos").alias("gone")
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key(F.col("text")).alias("text_key"))
    joined = rows.join(drops, rows["doc_id"].eqNullSafe(drops["_id"]) & (rows["text_key"] == drops["_key"]), "left")

    def rebuilt(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n").alias("kept"),
        )

    whole = F.struct(
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.col("text").alias("kept"),
    )
    result = F.when(F.col("gone").isNull(), whole).otherwise(bind(text_lines(F.col("text")), rebuilt))
    return joined.select("doc_id", F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"), result.alias("r")).select(
        "doc_id", "r.n_lines", "n_dropped", "r.kept"
    )

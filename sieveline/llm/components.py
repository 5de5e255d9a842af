"""Connected components of a link table, by alternating star contractions.

Large-star and small-star rounds (Kiveris et al. 2014) move every link to the
smallest known neighbour until the links form stars.  The number of rounds grows
with the logarithm of the components' sizes, and every round is two groupings and
two joins with constant-size rows, so no component ever sits in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(links: DataFrame):
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first())


def connected(links: DataFrame) -> DataFrame:
    """``u, v``: for every node with a link, except each component's smallest, the
    smallest node it can reach.

    ``links`` has long columns ``u, v``; order and repeats do not matter, links of
    a node to itself are ignored.  An empty table gives an empty table.
    """
    shared_dir(links.sparkSession)
    links = links.filter("u != v").select("u", "v").distinct().checkpoint()
    before = _digest(links)
    while True:
        links = _small_star(_large_star(links)).checkpoint()
        after = _digest(links)
        if after == before:
            return links
        before = after

"""Connected components of a graph given as links, by alternating stars.

Links point from the larger to the smaller node. A large-star step hangs every larger neighbour
of a node on the smallest node known there, a small-star step does so with the smaller ones; the
links shrink to stars around the smallest node of each component in about log(n) squared steps. A step is
two sums by key and two joins. A hub's links meet one row of minima in a join, which
adaptive execution may split; nothing is gathered per node. Every step is written to the shared
folder, so lost executors cost one step at most. A step makes at most two links of one, so the links
of the step before bound its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("b").alias("u"), F.col("a").alias("v")).unionByName(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return links.join(least, links["b"] == least["u"]).select("a", F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = links.join(least, links["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    hung = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").unionByName(hung).distinct()


def _mark(links: DataFrame) -> tuple:
    """Number of the links and a sum over them, which tell whether a step has changed any."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_steps: int = 60) -> DataFrame:
    """node, root for every node of the links (a, b); the root is the smallest node reachable.

    Null ends and links of a node to itself are no links; repeated links count once. No links, no
    rows. Nodes without a link are not listed.
    """
    now = written(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = _mark(now)
    for _ in range(most_steps):
        now = written(_small_star(_large_star(now)), "stars", rows=2 * mark[0])
        seen = _mark(now)
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components still change after {most_steps} steps")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

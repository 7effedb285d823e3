"""Connected components of a graph given as links, by alternating large-star and small-star steps.

A step replaces each node's links by links to the smallest neighbour, through a grouped minimum (combined before
it is shuffled) and a join; no neighbour list is ever gathered. Each round is written to the shared folder, so the
lineage stays short. It ends when a round changes nothing: then each node links to the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _joined(links: DataFrame) -> DataFrame:
    """Each link (a, b) with m, the smallest of a and what a is linked with."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    # a + 0 is dealt anew, so that the links of a hub can be split.
    return links.join(least, (F.col("a") == F.col("c")) & (F.xxhash64("a") == F.xxhash64("c")))


def _large_star(links: DataFrame) -> DataFrame:
    return _joined(_both_ways(links)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    near = _joined(down)
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(near.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that a link (a, b) touches; component is the smallest node reached."""
    links = materialize(links.select("a", "b").where("a <> b"), "links")
    if not links.isEmpty():
        mark = None
        for _ in range(most_rounds):
            links = materialize(_small_star(_large_star(links)), "links")
            new = _mark(links)
            if new == mark:
                break
            mark = new
        else:
            raise RuntimeError("components did not settle")
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

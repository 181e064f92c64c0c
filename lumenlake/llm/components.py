"""Connected components of links that may outgrow any one machine.

Alternating stars: every node is linked to the least node near it, larger
neighbours first, then smaller ones, until the links are stars around the
least node of each component.  All steps are aggregations and joins on a node;
the links of each round are written, and only two sums reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumenlake.llm.common import written


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    return (
        both.where("b > a").join(least, F.col("a") == F.col("node"))
        .select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the larger node ``a`` to the smaller ``b``."""
    least = _least(links)
    around = links.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    moved = around.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that a link of (a, b) names; component is its least node.

    Null ends and links of a node to itself are ignored.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, before = written(links.distinct(), "links"), None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

"""Connected components of a graph that only exists as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the component is its smallest node.

    Alternates large-star and small-star steps (each node hands its larger, then its smaller, neighbours to the smallest
    one it knows) until the table of links no longer changes; it is then a star around each smallest node. A step is a
    grouped minimum and a join, so no component is ever gathered in one task. Self-links, repeated links and both
    directions of a link are allowed; nulls take no part. No links give an empty table.
    """
    links = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter(F.col("a") != F.col("b")).distinct(), "links")
    nodes = stage(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    before = _state(links)
    while before[0]:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        larger = links.select(F.col("b").alias("a"), F.col("a").alias("far")).join(least, "a")
        # for node a: each larger neighbour is tied to the smallest of a and its neighbours
        large = larger.select(F.col("far").alias("a"), F.least("a", "m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a")
        small = (tied.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        links = stage(small, "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return nodes.join(links.groupBy("a").agg(F.min("b").alias("b")), nodes["node"] == F.col("a"), "left").select(
        "node", F.coalesce("b", "node").alias("component"))

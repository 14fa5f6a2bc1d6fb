"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmart.llm.staging import stage


def _to_least(links: DataFrame, larger: bool) -> DataFrame:
    """Give each node's ``larger`` (or else smaller and own) neighbours the node's least neighbour.

    The minimum is taken by a grouped aggregation and joined back, so a node with very many links is neither
    collected nor kept in one task.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if larger else both.filter("b < a")
    least = side.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = both.filter("b > a") if larger else side
    moved = moved.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its least node.

    Large-star and small-star steps in turn, each written out, until nothing changes: the number of rounds grows
    with the logarithm of the longest path. Links from a node to itself add nothing; NULL ends are left out.
    With ``rounds`` it may stop before the end: nodes with one component are then linked, but not all that are
    linked have one.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(links, "links")
    mark = links.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
    done = 0
    while mark[0] and done != rounds:
        done += 1
        links = stage(_to_least(_to_least(links, True), False), "links")
        last, mark = mark, links.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if mark == last:
            break
    own = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    every = links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
    return every if rounds is None else every.groupBy("node").agg(F.min("component").alias("component"))

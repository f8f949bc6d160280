"""Connected components of a graph in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstats.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``); the root is the smallest node.

    Each round first links the larger neighbours of every node to its smallest neighbour, then the
    smaller ones and the node itself; the smallest are found by partial aggregation, and no list of
    neighbours is gathered. Nodes come to hang from their roots after a logarithmic number of rounds.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).filter("b > a").select(
            F.col("b").alias("a"), F.least("m", "a").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "large-stars")
        least = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        joined = large.join(least, F.col("a") == F.col("k"))
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct(), "small-stars")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))


def _mark(edges: DataFrame) -> tuple:
    digest = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(digest)).first())

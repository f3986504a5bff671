"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencelake.llm.common import stash


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b: long) to (node, root): root is the smallest id of the node's component; roots are left out.

    Each step is a grouped minimum and a join, and each round is written to the shared folder, so lineage stays short.
    A hub's edges are merged before the shuffle of each minimum.  The minima are written too, so that the join that brings
    a hub's minimum to its edges has a plain table on either side: small minima are broadcast by their size on disk, and
    a hub's edges are split over tasks otherwise.  An empty table gives an empty result; loops (a = b) and repeated edges
    count for nothing; null ends are left out.
    """
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stash(edges, name)
    state = None
    while (now := digest(edges)) != state:
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        least = stash(least, name)
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stash(large.filter("a != b").distinct(), name)
        below = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        below = stash(below, name)
        small = large.join(below, F.col("a") == F.col("u"))
        small = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        edges = stash(small, name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(mixed, 20)), F.bit_xor(mixed)).first())

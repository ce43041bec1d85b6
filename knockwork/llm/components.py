"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwork.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node reachable.

    Large-star and small-star rounds: each node links its larger, then its smaller
    neighbours to the smallest it knows. Edges only ever shrink towards stars, minima are
    aggregated before the shuffle, and each round is a written table, so a component may
    be of any size. Rounds end when none changes an edge. Loops and repeated edges are harmless.
    """
    star = scratch.keep(_pairs(edges, F.col(a), F.col(b)).distinct(), "edges")
    mark = _mark(star)
    while True:
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.keep(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = scratch.keep(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        scratch.drop(large)
        scratch.drop(star)
        star, before, mark = following, mark, _mark(following)
        if mark == before:
            roots = star.select(F.col("v").alias("u"), "v").distinct()
            return star.union(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))


def _pairs(edges: DataFrame, a, b) -> DataFrame:
    """Larger node first."""
    return edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

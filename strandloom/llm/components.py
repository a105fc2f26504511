"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step points nodes at smaller neighbours with grouped minima and joins, so no node's neighbours are ever listed in one
place; a few rounds (logarithmic in the longest path) leave every node linked to the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import staged


def _star(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v): link every v to the least of u and its v's."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(staged(least, "least", slim=True), "u")


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) to (node, label): label is the smallest node of its component; nodes without a link are absent."""
    edges = staged(links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links", slim=True)
    while True:
        ends = edges.select(F.col("lo").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(edges.select("hi", F.lit(0), F.lit(1)))
        open_ = ends.groupBy("n").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).where("high > 1 or (high = 1 and low > 0)")
        if open_.isEmpty():
            break
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select("hi", "lo"))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "large", slim=True)  # every u has smaller v's only
        small = _star(large)
        small = small.select(F.col("v").alias("x"), "m").union(small.select("u", "m")).where("x <> m")
        edges = staged(small.select(F.col("m").alias("lo"), F.col("x").alias("hi")).distinct(), "links", slim=True)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(edges.select("lo", "lo").distinct())

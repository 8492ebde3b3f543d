"""Connected components of a table of links, by alternating large-star and small-star steps.

Each round replaces links by links to smaller neighbours and is written to the shared folder, so a lost executor costs one
round. The rounds end when a round leaves the links as they were: every node then hangs on its component's smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemetrics.llm.common import stored


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link to another one; ``links`` has columns a and b, in any order, repeats allowed."""
    e = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = stored(e.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "links")
    before, now = None, _mark(e)
    while before != now:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = stored(large, "links")  # repeats go with the small stars
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = rest.unionByName(low.select("a", F.col("m").alias("b")))
        e = stored(small.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "links")
        before, now = now, _mark(e)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

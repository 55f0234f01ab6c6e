"""Connected components over links between long ids, in DataFrame operations.

Alternates large-star and small-star steps (Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: Connected Components in
MapReduce and Beyond, 2014): each step replaces a node's links by links to its smallest neighbour. The links never grow
in number, the rounds grow with the logarithm of the longest path, and each round is a map-side-combined minimum and
one join, so no group is collected anywhere. Each round is a written table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (u, v), u > v, distinct. Large star: a node's larger neighbours are linked to its smallest; small: the smaller ones."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    joined = both.join(least, both["u"] == least["_u"])
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; component is the smallest node reachable. links: (a long, b long)."""
    scratch = Scratch(spark, "components")
    now = scratch.cut(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    sign = None
    while True:
        after = scratch.cut(_star(_star(now, True), False))
        scratch.drop(now)
        now = after
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == sign:
            break
        sign = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Surrogate ids: consecutive numbers in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch


def number(df: DataFrame, order: list, name: str = "id", start: int = 1) -> DataFrame:
    """df with start, start+1, ... in the given order: a range sort, then each partition's offset from the counts before it.

    The sorted rows are written once, so that counts and rows see the same partitions; the offsets are one row a partition.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = Scratch(spark, "number").cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(name, (F.col("_offset") + within + start).cast("long")).drop("_part", "_offset", "_at")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order, as a map-side-combined minimum instead of a window over the key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return picked.select(*keys, "_first.*")

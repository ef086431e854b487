"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node sends its larger (or its smaller) neighbours to the smallest node it knows, itself included."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    if large:
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.where("v < u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links: u, v of one orderable type -> node, root for each linked node; root is the smallest node of its component.

    A hub's neighbours are never gathered: minima are aggregated in part before the shuffle, and the joins that follow
    are plain ones, which adaptive execution splits. Every round is written to the shared folder.
    """
    now = durable(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        now = durable(_star(_star(now, True), False))
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = tuple(found)

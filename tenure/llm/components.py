"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _flat(edges: DataFrame) -> bool:
    """Whether each a has one edge and no b is an a."""
    roles = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    roles = roles.unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = roles.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id) of every id in ``edges`` (a, b).

    Each step hangs all neighbours of a node on their smallest one: first the
    larger neighbours, then the smaller.  Neighbours are never gathered: their
    minimum is aggregated and joined back, so a node may have any number of
    edges.  The steps end when every node hangs on its root alone.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = save(edges.where("a != b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    while not _flat(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = save(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "stars")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)

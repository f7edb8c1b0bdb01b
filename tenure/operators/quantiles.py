"""Exact medians without a task that holds all values.

Values are counted, range-partitioned by (group, value) and summed per (group, partition);
running sums over a group's partitions, of which there are few, tell which
partition holds the middle ranks, and only there the values are run through.
A group of any number of distinct values is spread over partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grouped_medians(values: DataFrame, group: list[str], value: str = "value") -> DataFrame:
    """(group..., ``median``): exact, the mean of both middle values for an even
    count.  Null values are left out; a group without values has no row."""
    from tenure.operators.sampling import _checkpoint

    counts = values.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = _checkpoint(counts.repartitionByRange(*group, "_v").withColumn("_pid", F.spark_partition_id()))
    parts = ranged.groupBy(*group, "_pid").agg(F.sum("_n").alias("_part"))
    upto = F.sum("_part").over(Window.partitionBy(*group).orderBy("_pid"))
    total = F.sum("_part").over(Window.partitionBy(*group))
    parts = parts.select(*group, "_pid", (upto - F.col("_part")).alias("_before"), upto.alias("_upto"), total.alias("_total"))
    low, high = F.expr("(_total - 1) div 2"), F.expr("_total div 2")
    inside = lambda rank, a, b: (rank >= F.col(a)) & (rank < F.col(b))
    parts = parts.where(inside(low, "_before", "_upto") | inside(high, "_before", "_upto")).drop("_upto")
    run = F.sum("_n").over(Window.partitionBy(*group, "_pid").orderBy("_v"))
    rows = ranged.join(parts, [*group, "_pid"]).withColumn("_end", F.col("_before") + run).withColumn("_start", F.col("_end") - F.col("_n"))
    pick = lambda rank: F.max(F.when(inside(rank, "_start", "_end"), F.col("_v")))
    return rows.groupBy(*group).agg((pick(low) * F.lit(0.5) + pick(high) * F.lit(0.5)).alias("median"))


def column_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the exact median of each column (null without values)."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(columns)])
    long = df.select(F.explode(pairs).alias("x")).select("x.i", "x.value")
    found = grouped_medians(long, ["i"])
    return found.agg(*[F.max(F.when(F.col("i") == i, F.col("median"))).alias(c) for i, c in enumerate(columns)])

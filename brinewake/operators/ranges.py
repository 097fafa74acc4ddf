"""Range joins by buckets, and running sums that no single task has to walk through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def range_join(points: DataFrame, intervals: DataFrame, at: str, low: str, high: str, width: float, on: tuple[str, ...] = (), how: str = "inner") -> DataFrame:
    """Pairs with low <= at <= high (numbers).

    Intervals are expanded to the buckets of ``width`` that they touch and equi-joined with the
    points' buckets, so the plan is a hash or sort-merge join, never a nested loop.  A point lies
    in one bucket, so a pair meets once.  ``how``: inner, or left_semi / left_anti on points.
    """
    i = intervals.where(F.col(low) <= F.col(high)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    p = points.withColumn("_bucket", F.floor(F.col(at) / width))
    keys = [*on, "_bucket"]
    hit = (F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))
    if how == "inner":
        return p.join(i, keys).where(hit).drop("_bucket")
    renamed = i.select(*[F.col(k).alias(f"_i_{k}") for k in keys], low, high)
    same = hit
    for k in keys:
        same = same & (F.col(k) == F.col(f"_i_{k}"))
    return p.join(renamed, same, how).drop("_bucket")


def running_before(df: DataFrame, group: tuple[str, ...], order: str, tie: tuple[str, ...], value: Column, out: str, width: int = 1 << 16) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the group's rows before this one (0 for the first).

    Rows are cut into blocks of ``width`` of the (long) order column; block totals are summed up
    first, in a table as small as the number of blocks, and each block is then walked by itself: a
    hot group spreads over many tasks.
    """
    keys = [*group, "_block"]
    d = df.withColumns({"_block": F.floor(F.col(order) / width), "_value": value})
    totals = d.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    before = W.partitionBy(*group, F.lit(0)).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    within = W.partitionBy(*keys).orderBy(order, *tie).rowsBetween(W.unboundedPreceding, -1)
    return d.join(totals, keys).withColumn(out, F.col("_offset") + F.coalesce(F.sum("_value").over(within), F.lit(0))).drop("_block", "_value", "_offset")

"""Summaries of a data set, and tables for maps and charts."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import times
from .ranges import running_before


def class_report(meta: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Per class of the list: distinct vessels, first and last date, total time, rows."""
    names = meta.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("label"))
    sums = meta.groupBy("label").agg(F.countDistinct("MMSI").alias("n_vessels"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("duration_us").alias("total_us"), F.count("*").alias("n_clips"))
    d = names.join(sums, "label", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_vessels", "total_us", "n_clips")}
    return d.withColumns(zero).withColumn("duration", times.duration_text(F.expr("total_us div 1000000")))


def report_lines(report: DataFrame) -> DataFrame:
    """One line of text per class."""
    return report.select(F.concat_ws(" | ", "label", F.col("n_vessels").cast("string"), F.col("first_date").cast("string"), F.col("last_date").cast("string"), "duration", F.col("n_clips").cast("string")).alias("value"))


def vessel_counts(steps: dict[str, DataFrame], vessel: str = "mmsi") -> DataFrame:
    """(step, rows, vessels): what each step of the cleaning has left."""
    out = [d.agg(F.lit(n).alias("step"), F.count("*").alias("n_rows"), F.countDistinct(vessel).alias("n_vessels")) for n, d in steps.items()]
    return functools.reduce(DataFrame.unionByName, out)


def bar_table(rows: DataFrame, value: str, order: Sequence[str], scale: float = 1e6) -> DataFrame:
    """Bars of a chart: ``position`` by value (of at least 0, ties by ``order``), invalid rows before
    valid ones.  Rows without a value have no bar.

    Positions are running counts in blocks of values, so no task walks through the table.
    """
    d = rows.where(F.col(value).isNotNull()).withColumn("_key", F.floor(F.col(value) * scale).cast("long"))
    d = running_before(d, ("valid",), "_key", (value, *order), F.lit(1).cast("long"), "position").drop("_key")
    before = rows.agg(F.count_if((~F.col("valid")) & F.col(value).isNotNull()).alias("_before"))
    d = d.crossJoin(F.broadcast(before))  # one row
    return d.withColumn("position", F.col("position") + F.when(F.col("valid"), F.col("_before")).otherwise(0)).drop("_before")


def track_points(messages: DataFrame, keys: Sequence[str] = ("mmsi",), values: Sequence[str] = ("x", "y")) -> DataFrame:
    """Rows of tracks with gaps in positions filled, linear in the row's place; rows before the first
    known position go (none is known there), those behind the last keep it."""
    w = W.partitionBy(*keys).orderBy("at_us")
    d = messages.withColumn("_rn", F.row_number().over(w).cast("double"))
    back, ahead = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    for c in values:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_rn").alias("p"), F.col(c).alias("v")))
        d = d.withColumns({"_a": F.last(known, ignorenulls=True).over(back), "_b": F.first(known, ignorenulls=True).over(ahead)})
        share = F.coalesce(F.try_divide(F.col("_rn") - F.col("_a.p"), F.col("_b.p") - F.col("_a.p")), F.lit(0.0))
        d = d.withColumn(c, F.when(F.col("_b").isNull(), F.col("_a.v")).otherwise(F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * share)).drop("_a", "_b")
    return d.drop("_rn").dropna(subset=list(values))


def map_features(messages: DataFrame, stations: DataFrame, radii: Sequence[int]) -> DataFrame:
    """GeoJSON features: a point per message, a circle (centre and radius) per station and radius."""
    point = lambda x, y: F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))
    p = messages.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point(F.col("x"), F.col("y")).alias("geometry"), F.struct("mmsi").alias("properties"))).alias("feature"))
    c = stations.withColumn("radius", F.explode(F.array(*[F.lit(r) for r in radii])))
    c = c.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point(F.col("sx"), F.col("sy")).alias("geometry"), F.struct("station", "radius").alias("properties"))).alias("feature"))
    return p.unionByName(c)


def colour_ramp(n: int) -> list[str]:
    """``n`` hex colours from blue to red."""
    return [f"#{round(255 * i / max(n - 1, 1)):02x}00{255 - round(255 * i / max(n - 1, 1)):02x}" for i in range(n)]

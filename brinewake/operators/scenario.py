"""Scenario identification: time bins with one vessel, or none, near a station.

Bins are classified for every radius in one pass over the messages (conditional counts and the
least and greatest vessel, no cross join), runs of bins with equal steps become intervals, and the
cascade gives each bin to the largest radius that can use it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import times
from ..functions.labels import EXCLUSION_MARGIN
from .ranges import range_join


def classify_bins(messages: DataFrame, radii: Sequence[int], step_us: int = times.MINUTE, keys: Sequence[str] = (), margin: int = EXCLUSION_MARGIN) -> DataFrame:
    """(keys, bin_us, n_in_r, n_out_r, kind_r for every radius r), one row per bin.

    ``messages``: keys, mmsi, at_us, distance.  Bins without messages between the first and the
    last are kept: they are background time.
    """
    m = messages.withColumn("bin_us", times.floor_us(F.col("at_us"), step_us))
    aggregates = []
    for r in radii:
        near, around = F.col("distance") <= r, F.col("distance") <= r + margin
        aggregates += [F.count_if(near).alias(f"n_in_{r}"), F.count_if(around).alias(f"n_out_{r}")]
        aggregates += [F.min(F.when(around, F.col("mmsi"))).alias(f"lo_{r}"), F.max(F.when(around, F.col("mmsi"))).alias(f"hi_{r}")]
    counts = m.groupBy(*keys, "bin_us").agg(*aggregates)
    ends = counts.groupBy(*keys).agg(F.min("bin_us").alias("first"), F.max("bin_us").alias("last"))
    spine = ends.where("first is not null").select(*keys, F.explode(F.sequence("first", "last", F.lit(step_us))).alias("bin_us"))
    out = spine.join(counts, [*keys, "bin_us"], "left")
    for r in radii:
        inside, around = F.coalesce(F.col(f"n_in_{r}"), F.lit(0)), F.coalesce(F.col(f"n_out_{r}"), F.lit(0))
        one = (F.col(f"lo_{r}") == F.col(f"hi_{r}")) & (inside == around)
        out = out.withColumns({f"n_in_{r}": inside, f"n_out_{r}": around, f"kind_{r}": F.when(around == 0, "background").when(one, "vessel").otherwise("none")}).drop(f"lo_{r}", f"hi_{r}")
    return out


def long_bins(wide: DataFrame, radii: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """One row per bin and radius: (keys, inclusion_radius, bin_us, n_inclusion, n_exclusion, kind)."""
    rows = F.array(*[F.struct(F.lit(r).cast("int").alias("inclusion_radius"), F.col(f"n_in_{r}").alias("n_inclusion"), F.col(f"n_out_{r}").alias("n_exclusion"), F.col(f"kind_{r}").alias("kind")) for r in radii])
    return wide.select(*keys, "bin_us", F.inline(rows))


def runs(bins: DataFrame, keys: Sequence[str], step_us: int, least: Column, strict: bool = False) -> DataFrame:
    """Runs of bins with equal differences, as intervals (keys, n_bins, begin_us, end_us).

    A bin's difference is to the bin before it (the first has 0), so a run's first bin belongs to
    the gap before; the interval starts at the run's first counted bin and ends a step after its
    last.  ``strict`` only takes runs of difference one step.  ``least``: bins a run needs.
    """
    w = W.partitionBy(*keys).orderBy("bin_us")
    d = bins.select(*keys, "bin_us").withColumn("diff", F.coalesce((F.col("bin_us") - F.lag("bin_us").over(w)) / step_us, F.lit(0.0)))
    d = d.withColumn("new", F.when(F.col("diff").eqNullSafe(F.lag("diff").over(w)), 0).otherwise(1))
    d = d.withColumn("run", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    out = d.groupBy(*keys, "run").agg(F.count("*").alias("n_bins"), F.min("bin_us").alias("begin_us"), (F.max("bin_us") + step_us).alias("end_us"), F.min("diff").alias("diff"))
    out = out.where(F.col("n_bins") >= least)
    return (out.where("diff = 1") if strict else out).drop("run", "diff")


def cascade(wide: DataFrame, radii: Sequence[int], keys: Sequence[str], step_us: int, least: dict[str, int], strict: bool = False) -> DataFrame:
    """Intervals (keys, kind, inclusion_radius, n_bins, begin_us, end_us), largest radius first.

    Bins used at a radius are out for every smaller one, for background and vessel apart.  All
    radii run as windows over one partitioning (keys, kind): the plan grows by a few windows a
    radius and needs one exchange, no anti joins and no intermediate tables.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).cast("long").alias("least")) for k, n in least.items()]))
    d = wide.select(*keys, "bin_us", *[f"kind_{r}" for r in radii], kinds.alias("k")).select(*keys, "bin_us", "k.kind", "k.least", *[F.col(f"kind_{r}") for r in radii])
    d = d.select(*keys, "bin_us", "kind", "least", *[(F.col(f"kind_{r}") == F.col("kind")).alias(f"fits_{r}") for r in radii], F.lit(None).cast("int").alias("radius"), F.lit(None).cast("long").alias("run"))
    own = [*keys, "kind"]
    w = W.partitionBy(*own).orderBy("bin_us")
    upto, past = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    for r in sorted(radii, reverse=True):
        d = d.withColumn("open", F.col("radius").isNull() & F.col(f"fits_{r}"))
        d = d.withColumn("diff", F.when(F.col("open"), F.coalesce((F.col("bin_us") - F.last(F.when(F.col("open"), F.col("bin_us")), ignorenulls=True).over(past)) / step_us, F.lit(0.0))))
        d = d.withColumn("new", F.when(F.col("open") & ~F.col("diff").eqNullSafe(F.last("diff", ignorenulls=True).over(past)), 1).otherwise(0))
        d = d.withColumn("at", F.sum("new").over(upto))
        size = F.count_if("open").over(W.partitionBy(*own, "at"))
        used = F.col("open") & (size >= F.col("least")) & ((F.col("diff") == 1) if strict else F.lit(True))
        d = d.withColumn("used", used)
        d = d.withColumns({"radius": F.when(F.col("used"), F.lit(r)).otherwise(F.col("radius")), "run": F.when(F.col("used"), F.col("at")).otherwise(F.col("run"))})
        d = d.drop("open", "diff", "new", "at", "used")
    out = d.where("radius is not null").groupBy(*own, F.col("radius").cast("int").alias("inclusion_radius"), "run")
    return out.agg(F.count("*").alias("n_bins"), F.min("bin_us").alias("begin_us"), (F.max("bin_us") + step_us).alias("end_us")).drop("run")


def interval_messages(intervals: DataFrame, messages: DataFrame, pad_us: int = times.MINUTE, width_us: int = 60 * times.MINUTE, keys: tuple[str, ...] = ()) -> DataFrame:
    """Messages within each interval, padded on both sides, both ends inclusive."""
    padded = intervals.withColumns({"low_us": F.col("begin_us") - pad_us, "high_us": F.col("end_us") + pad_us})
    return range_join(messages, padded, "at_us", "low_us", "high_us", width_us, keys).drop("low_us", "high_us")



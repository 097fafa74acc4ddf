"""Filling of short gaps in vessel tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import times

# fixed values: gaps over 20 s and up to 1200 s are filled, a point about every 20 s
SHORTEST_US, LONGEST_US = 20 * times.SECOND, 1200 * times.SECOND


def repeated_vessels(messages: DataFrame, keys: Sequence[str] = ("mmsi",)) -> DataFrame:
    """Messages of vessels with more than one message: those with a neighbour.

    The window's exchange is the one that gaps and interpolation need, so it costs no shuffle.
    """
    w = W.partitionBy(*keys).orderBy("at_us")
    one = F.lit(1)
    return messages.withColumns({"_before": F.lag(one).over(w), "_after": F.lead(one).over(w)}).where("_before is not null or _after is not null").drop("_before", "_after")


def gaps(messages: DataFrame, keys: Sequence[str] = ("mmsi",)) -> DataFrame:
    """Adds prev_us, gap_us and whether the gap can be filled."""
    before = F.lag("at_us").over(W.partitionBy(*keys).orderBy("at_us"))
    d = messages.withColumn("prev_us", before).withColumn("gap_us", F.col("at_us") - F.col("prev_us"))
    return d.withColumn("fillable", F.coalesce((F.col("gap_us") > SHORTEST_US) & (F.col("gap_us") <= LONGEST_US), F.lit(False)))


def _step_times() -> Column:
    """Times of the synthetic points of a gap, in whole microseconds by integer division: ceil(gap / 20 s)
    of them, equally spaced, the first at the earlier message's time.  Empty where there is no gap."""
    steps = F.ceil(F.col("gap_us") / SHORTEST_US).cast("long")
    points = F.transform(F.sequence(F.lit(0).cast("long"), steps - 1), lambda i: F.struct(i.cast("int").alias("step"), (F.col("prev_us") + F.call_function("div", i * F.col("gap_us"), steps)).alias("at_us")))
    return F.when(F.col("fillable"), points).otherwise(F.array().cast("array<struct<step:int,at_us:bigint>>"))


def exact_steps(with_gaps: DataFrame, keys: Sequence[str] = ("mmsi",)) -> DataFrame:
    """Synthetic times (keys, step, at_us) of fillable gaps."""
    return with_gaps.where("fillable").select(*keys, F.inline(_step_times()))


def interpolated(messages: DataFrame, values: Sequence[str], carried: Sequence[str] = ("id", "type_and_cargo"), keys: Sequence[str] = ("mmsi",), method: str = "position") -> DataFrame:
    """Real rows and synthetic rows (``is_interpolated``) with values filled in.

    Rows are ordered by (time, real first).  ``position``: a value between two known ones is linear
    in the row's position; ``time``: linear in time.  Behind the last known value it stays, before
    the first it is NULL.  ``carried`` columns of synthetic rows take the last known value.  One scan
    and one exchange by ``keys`` serve the gaps and all windows.
    """
    # a message gives its own row and those of the gap before it: one scan, no union
    own = F.array(F.struct(F.lit(None).cast("int").alias("step"), F.col("at_us").alias("at_us")))
    d = gaps(messages, keys).select(*keys, *[F.struct(*carried, *values).alias("_m")], F.explode(F.concat(_step_times(), own)).alias("_p"))
    real = F.col("_p.step").isNull()
    d = d.select(*keys, F.col("_p.at_us").alias("at_us"), (~real).alias("is_interpolated"), *[F.when(real, F.col(f"_m.{c}")).alias(c) for c in (*carried, *values)])
    w = W.partitionBy(*keys).orderBy("at_us", F.col("is_interpolated").cast("int"))
    d = d.withColumn("rn", F.row_number().over(w).cast("double"))
    back, ahead = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    place = F.col("rn") if method == "position" else F.col("at_us").cast("double")
    known = {c: F.when(F.col(c).isNotNull(), F.struct(place.alias("p"), F.col(c).alias("v"))) for c in values}
    d = d.withColumns({f"_a_{c}": F.last(s, ignorenulls=True).over(back) for c, s in known.items()} | {f"_b_{c}": F.first(s, ignorenulls=True).over(ahead) for c, s in known.items()})

    def filled(c: str) -> Column:
        a, b = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        between = a["v"] + (b["v"] - a["v"]) * F.coalesce(F.try_divide(place - a["p"], b["p"] - a["p"]), F.lit(0.0))
        return F.when(F.col(c).isNotNull(), F.col(c)).when(a.isNull(), F.lit(None)).when(b.isNull(), a["v"]).otherwise(between)

    carry = {c: F.when(F.col("is_interpolated"), F.last(c, ignorenulls=True).over(back)).otherwise(F.col(c)) for c in carried}
    return d.withColumns({c: filled(c) for c in values} | carry).select(*keys, "at_us", "is_interpolated", *carried, *values)

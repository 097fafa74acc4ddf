"""Fluctuation of a signal: what is left of it above its median filter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def median_filter(samples: Column, kernel: int, edges: str = "reflect") -> Column:
    """Running median of an array of numbers (a column as it is read: it is indexed many times); ``edges``: reflect (the edge sample repeats) or zero.

    For an even kernel the window reaches half a kernel back, and the upper of the two middle values
    counts.  Array functions only; for long audio see ``audio.fluctuation``.
    """
    half = kernel // 2
    n = F.size(samples)

    def sample(i: Column) -> Column:
        if edges == "zero":
            return F.when((i < 0) | (i >= n), F.lit(0.0)).otherwise(F.get(samples, i).cast("double"))
        turn = F.pmod(i, 2 * n)
        return F.get(samples, F.when(turn < n, turn).otherwise(2 * n - 1 - turn)).cast("double")

    return F.transform(samples, lambda _, i: F.get(F.array_sort(F.array(*[sample(i + k) for k in range(-half, kernel - half)])), F.lit(kernel // 2)))


def population_std(values: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    add = lambda t, v: F.struct((t["n"] + 1).alias("n"), (t["s"] + v).alias("s"), (t["q"] + v * v).alias("q"))
    return F.aggregate(values, zero, add, lambda t: F.sqrt(F.greatest(F.lit(0.0), F.try_divide(t["q"], t["n"]) - F.pow(F.try_divide(t["s"], t["n"]), F.lit(2)))))


def fluctuation(samples: Column, kernel: int, edges: str = "reflect") -> Column:
    """Population deviation of (signal - median filter)."""
    return population_std(F.zip_with(samples, median_filter(samples, kernel, edges), lambda a, b: a.cast("double") - b))

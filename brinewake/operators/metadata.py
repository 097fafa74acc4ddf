"""Water readings, labels and enrichment of clips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import class_of, min_max
from .ranges import range_join


def mean_readings(intervals: DataFrame, readings: DataFrame, columns: Sequence[str], width_us: int, keys: Sequence[str]) -> DataFrame:
    """Means of the readings within each interval, both ends inclusive; NULL where there are none.

    Readings are first summed per distinct time, so a dense series meets the intervals as few rows.
    ``keys`` identify an interval (with begin_us, end_us); ``readings``: at_us.
    """
    sums = [F.sum(c).alias(f"_s_{c}") for c in columns] + [F.count(c).alias(f"_n_{c}") for c in columns]
    dense = readings.groupBy("at_us").agg(*sums)
    d = range_join(dense, intervals.select(*keys, "begin_us", "end_us"), "at_us", "begin_us", "end_us", width_us)
    means = d.groupBy(*keys).agg(*[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(c) for c in columns])
    return intervals.join(means, list(keys), "left")


def scaled(rows: DataFrame, readings: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``c_norm``: min-max scaled by the ends of all readings (one row, so cheap to send)."""
    ends = readings.agg(*[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns])
    d = rows.crossJoin(F.broadcast(ends))  # exactly one row
    return d.withColumns({f"{c}_norm": min_max(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")) for c in columns}).drop(*[f"_{p}_{c}" for p in ("lo", "hi") for c in columns])


def normalised(readings: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Readings scaled by the whole table."""
    return scaled(readings, readings, columns)


def first_vessel(messages: DataFrame, keys: Sequence[str], radius: float) -> DataFrame:
    """(type, mmsi) of the first message within the radius; a NULL type is not skipped."""
    near = messages.where(F.col("distance") <= radius)
    return near.groupBy(*keys).agg(F.min_by(F.struct("type_and_cargo", "mmsi"), "at_us").alias("v")).select(*keys, "v.*")


def labelled(clips: DataFrame, code_col: str = "class_code") -> DataFrame:
    return clips.withColumn("label", class_of(F.col(code_col)))


def enriched(messages: DataFrame, ships: DataFrame, key: str = "mmsi") -> DataFrame:
    """Left join with the ship table; Spark broadcasts it only if its size allows."""
    return messages.join(ships, key, "left")

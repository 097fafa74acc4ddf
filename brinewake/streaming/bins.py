"""Bin classification on a stream: tumbling windows under a watermark, late rows within it counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import EXCLUSION_MARGIN


def streaming_bins(messages: DataFrame, radii: Sequence[int], step: str = "1 minute", late: str = "10 minutes", margin: int = EXCLUSION_MARGIN) -> DataFrame:
    """(bin, kind_r ...) of bins that have messages; ``messages``: ts (TIMESTAMP), mmsi, distance.

    Empty bins can't arise from a stream alone; join the result with a spine for them.
    """
    out = []
    for r in radii:
        near, around = F.col("distance") <= r, F.col("distance") <= r + margin
        one = (F.min(F.when(around, F.col("mmsi"))) == F.max(F.when(around, F.col("mmsi")))) & (F.count_if(near) == F.count_if(around))
        out.append(F.when(F.count_if(around) == 0, "background").when(one, "vessel").otherwise("none").alias(f"kind_{r}"))
    d = messages.withWatermark("ts", late).groupBy(F.window("ts", step).alias("w")).agg(*out)
    return d.select(F.col("w.start").alias("bin"), *[f"kind_{r}" for r in radii])


def streaming_dedup(messages: DataFrame, keys: Sequence[str], late: str = "10 minutes") -> DataFrame:
    """Each message once, among those that arrive within the watermark."""
    return messages.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))

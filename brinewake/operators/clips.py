"""Which part of which recording shows which interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import times
from ..functions.labels import EXCLUSION_MARGIN
from .ranges import range_join

# fixed values: a recording lasts five minutes; a clip needs 3200 ms
RECORDING_US, SHORTEST_CLIP_MS = 5 * times.MINUTE, 3200


def with_radius(intervals: DataFrame, inclusion: int | None = None, exclusion: int | None = None) -> DataFrame:
    """The intervals of one radius; all of them if none is chosen."""
    if inclusion is None and exclusion is None:
        return intervals
    return intervals.where(F.col("inclusion_radius") == (inclusion if inclusion is not None else exclusion - EXCLUSION_MARGIN))


def overlaps(intervals: DataFrame, recordings: DataFrame, length_us: int = RECORDING_US, least_ms: int = SHORTEST_CLIP_MS, keys: tuple[str, ...] = ()) -> DataFrame:
    """(interval columns, recording columns, start_ms, stop_ms) of true overlaps.

    ``intervals``: keys, begin_us, end_us; ``recordings``: keys, wav_us (start).  A recording that
    starts up to its length before the interval counts, both ends inclusive; ``keys`` (the device) must
    agree.
    """
    i = intervals.withColumn("low_us", F.col("begin_us") - length_us)
    d = range_join(recordings, i, "wav_us", "low_us", "end_us", max(length_us, 10 * times.MINUTE), keys).drop("low_us")
    d = d.withColumns({"start_ms": F.greatest(F.lit(0), F.floor((F.col("begin_us") - F.col("wav_us")) / 1000)), "stop_ms": F.least(F.lit(length_us // 1000), F.floor((F.col("end_us") - F.col("wav_us")) / 1000))})
    return d.where(F.col("stop_ms") - F.col("start_ms") >= least_ms)


def numbered(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the interval's 0-based number in order of (begin, end), which names its clips."""
    return intervals.withColumn("clip_index", F.row_number().over(W.partitionBy(*keys).orderBy("begin_us", "end_us")) - 1)


def ordered_files(found: DataFrame, keys: Sequence[str], name: str = "path") -> DataFrame:
    """Per interval its recordings, by (time, name), each with the part that shows the interval."""
    part = F.struct("wav_us", F.col(name).alias("name"), "start_ms", "stop_ms")
    return found.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("files"))


def collapse(messages: DataFrame, file_col: str = "file", by: str = "mmsi", type_col: str = "type_and_cargo") -> DataFrame:
    """Ship segments: runs of typed messages, in time order within a file, of one vessel (or type).

    A segment ends at the next segment's begin, the last of a file at its own last message;
    segments without length go.
    """
    m = messages.where(F.col(type_col).isNotNull())
    w = W.partitionBy(file_col).orderBy("at_us")
    m = m.withColumn("new", F.when(F.col(by).eqNullSafe(F.lag(by).over(w)), 0).otherwise(1))
    m = m.withColumn("run", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    s = m.groupBy(file_col, "run").agg(F.min_by("mmsi", "at_us").alias("mmsi"), F.min_by(type_col, "at_us").alias(type_col), F.min("at_us").alias("begin_us"), F.max("at_us").alias("last_us"))
    s = s.withColumn("end_us", F.coalesce(F.lead("begin_us").over(W.partitionBy(file_col).orderBy("run")), F.col("last_us")))
    return s.where("begin_us < end_us").select(file_col, "mmsi", type_col, "begin_us", "end_us")


def excluded_type(code: Column) -> Column:
    """Types that make no clips: cargo, towing astern, pleasure craft."""
    return code.between(70, 79) | code.isin(52, 37)


def segment_recordings(segments: DataFrame, recordings: DataFrame, length_us: int = RECORDING_US, begin_in_recording: bool = False, file_col: str = "file") -> DataFrame:
    """Recordings of a segment's own day that overlap it: begin - length < start <= end.

    The day is an equi-key; within it the join is by buckets.  ``begin_in_recording`` also asks
    that the segment begins in the recording.
    """
    s = segments.where(~F.coalesce(excluded_type(F.col("type_and_cargo")), F.lit(False))).withColumn("low_us", F.col("begin_us") - length_us + 1)
    d = range_join(recordings, s, "wav_us", "low_us", "end_us", max(length_us, 10 * times.MINUTE), (file_col,)).drop("low_us")
    return d.where((F.col("begin_us") >= F.col("wav_us")) & (F.col("begin_us") <= F.col("wav_us") + length_us)) if begin_in_recording else d


def clip_name(device: Column, begin: Column, index: Column) -> Column:
    return F.concat(F.concat_ws("_", device, times.to_compact(begin), index.cast("string")), F.lit(".wav"))

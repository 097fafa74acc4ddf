"""Cleaning of position messages."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo, times
from .ranges import range_join

# fixed values: message ids that are read, and the first value of each field that means "not available"
POSITION_IDS, TYPE_ID, TYPE_PART_ID, BOTH_ID = (1, 2, 3, 18), 5, 24, 19
SENTINELS = {"x": 181, "y": 91, "sog": 1023, "cog": 3600, "true_heading": 511}
LONGEST_SHORT_DEPLOYMENT_DAYS = 60


def select_messages(raw: DataFrame) -> DataFrame:
    """Valid messages with the fields that their id carries; sentinels and absent fields are NULL.

    ``raw``: id, part_num, mmsi, the fields of SENTINELS and type_and_cargo; more columns pass.
    """
    position = F.col("id").isin(*POSITION_IDS, BOTH_ID)
    kind = (F.col("id") == TYPE_ID) | (F.col("id") == BOTH_ID) | ((F.col("id") == TYPE_PART_ID) & (F.col("part_num") == 1))
    m = raw.where((F.length(F.col("mmsi").cast("string")) == 9) & F.col("id").isin(*POSITION_IDS, TYPE_ID, TYPE_PART_ID, BOTH_ID))
    m = m.withColumns({c: F.when(position & (F.col(c) < top), F.col(c)) for c, top in SENTINELS.items()} | {"type_and_cargo": F.when(kind, F.nullif(F.col("type_and_cargo"), F.lit(0)))})
    return m.where(F.coalesce(*[F.col(c).cast("double") for c in (*SENTINELS, "type_and_cargo")]).isNotNull())


def fill_type(messages: DataFrame, file_col: str = "file", vessel_col: str = "mmsi", type_col: str = "type_and_cargo") -> DataFrame:
    """A missing type becomes the greatest type of the vessel in the file; others stay."""
    best = F.max(type_col).over(W.partitionBy(file_col, vessel_col))
    return messages.withColumn(type_col, F.coalesce(F.col(type_col), best))


def located(messages: DataFrame) -> DataFrame:
    """Rows with a position, each distinct row once."""
    return messages.dropna(subset=["x", "y"]).dropDuplicates()


def near_station(messages: DataFrame, stations: DataFrame, radius: float, distance=geo.haversine) -> DataFrame:
    """Messages within ``radius`` metres (rounded up) of each station, with the distance.

    Stations meet messages by bands of latitude as high as the box, an equi-join whatever their
    number; the box is tested next, across the 180th meridian too, and the distance only behind it.
    ``stations``: station, sx, sy.
    """
    high = math.degrees((radius + geo.BOX_MARGIN_M) / geo.EQUATOR_M)
    s = stations.select("station", "sx", "sy", (F.col("sy") - high).alias("_bottom"), (F.col("sy") + high).alias("_top"))
    d = range_join(messages, s, "y", "_bottom", "_top", 2 * high).drop("_bottom", "_top")
    d = d.where(geo.in_box(F.col("sx"), F.col("sy"), F.col("x"), F.col("y"), F.lit(float(radius))))
    d = d.withColumn("distance_to_station", distance(F.col("sx"), F.col("sy"), F.col("x"), F.col("y")))
    return d.where(F.ceil("distance_to_station") <= int(radius))


def in_deployments(files: DataFrame, deployments: DataFrame, at_us: str, keys: tuple[str, ...] = (), short_only: bool = False) -> DataFrame:
    """Files whose time lies in a deployment: begin floored to its day, end to the day after, both inclusive.

    ``deployments``: keys, device, begin, end (TIMESTAMP_NTZ).
    """
    d = deployments
    if short_only:
        d = d.where(times.epoch_us(F.col("end")) - times.epoch_us(F.col("begin")) <= LONGEST_SHORT_DEPLOYMENT_DAYS * 86_400 * times.SECOND)
    d = d.withColumns({"low_us": times.epoch_us(times.day_floor(F.col("begin"))), "high_us": times.epoch_us(times.day_after(F.col("end")))})
    return range_join(files, d, at_us, "low_us", "high_us", 7 * 86_400 * times.SECOND, keys).drop("low_us", "high_us")


def not_done(available: DataFrame, done: DataFrame, name: Column, done_name: Column) -> DataFrame:
    """Available rows whose normalised name is not in the manifest."""
    return available.withColumn("_name", name).join(done.select(done_name.alias("_name")).distinct(), "_name", "left_anti").drop("_name")

"""Schemas of the data sets.  Missing values are NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


DEPLOYMENT = "begin string, end string, latitude double, longitude double, depth double, location string"
POSITION = "x double, y double, sog double, cog double, true_heading double, type_and_cargo double, ais_timestamp string, mmsi long, id int"
WATER = "date timestamp_ntz, t1 double, c1 double, p1 double, sal double, sv double"
SCENARIO = "kind string, inclusion_radius int, exclusion_radius int, begin timestamp_ntz, end timestamp_ntz"
CLIP = "begin string, end string, wav_file int"
CLIP_DETAIL = "begin string, end string, wav_file int, ship_id long, typecargo int, filepath string"
SEGMENT = "ID long, begin string, end string, Type int, mmsi long"
METADATA = (
    "label string, duration_sec double, path string, sample_rate int, class_code int, date timestamp_ntz, MMSI long, "
    "t1 double, c1 double, p1 double, sal double, sv double, t1_norm double, c1_norm double, p1_norm double, sal_norm double, sv_norm double"
)
#: The CSV forms by name.
FORMS = {"deployments": DEPLOYMENT, "water": WATER, "intervals": SCENARIO, "clips": CLIP, "clip_details": CLIP_DETAIL, "segments": SEGMENT, "metadata": METADATA}


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, so that comparisons and aggregates agree."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType | T.FloatType)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in floating})

"""The driver's tables seen as vessel messages, clips, water readings and recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import epoch_us

#: Scenario parameters on the event data: ten-minute bins, four radii, least bins of a run.
STEP_US = 10 * 60 * 1_000_000
RADII = (1000, 3000, 6000, 10000)
LEAST = {"background": 3, "vessel": 2}
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
QUIET = "5-LOW"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ais(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    d = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    message = F.when(kind == "view", 1).when(kind == "click", 3).when(kind == "signup", 5).when(kind == "purchase", 18).otherwise(24)
    return d.select(
        "event_id",
        "ts",
        epoch_us(F.col("ts")).alias("at_us"),
        F.to_date("ts").alias("file"),
        F.col("user_id").alias("mmsi"),
        message.alias("id"),
        "k",
        (F.lit(-123.0) + F.col("k") / 500.0).alias("x"),
        (F.lit(49.0) + F.col("value") / 5000.0).alias("y"),
        F.when(F.col("k") % 10 != 0, F.col("k").cast("double")).alias("sog"),
        (F.col("value") * 7).alias("cog"),
        F.when(kind == "signup", 50 + F.col("k") % 40).alias("type_and_cargo"),
        (F.col("value") * 200).alias("distance"),
    )


AIS_SQL = """ais AS (
  SELECT event_id, ts, epoch_us(ts) AS at_us, CAST(ts AS DATE) AS file, user_id AS mmsi,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 3 WHEN 'signup' THEN 5 WHEN 'purchase' THEN 18 ELSE 24 END AS id,
    k, -123.0::DOUBLE + k / 500.0::DOUBLE AS x, 49.0::DOUBLE + value / 5000.0::DOUBLE AS y,
    CASE WHEN k % 10 <> 0 THEN k::DOUBLE END AS sog, value * 7 AS cog,
    CASE WHEN event_type = 'signup' THEN (50 + k % 40)::INTEGER END AS type_and_cargo, value * 200 AS distance
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
)"""


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").alias("label"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("duration_us"),
        F.col("o_custkey").alias("MMSI"),
        F.col("o_orderdate").alias("date"),
        (F.col("o_custkey") % 100).alias("class_code"),
    )


META_SQL = """meta AS (
  SELECT o_orderkey AS row_id, o_orderpriority AS label, round(o_totalprice * 100)::BIGINT AS duration_us,
    o_custkey AS MMSI, o_orderdate AS date, o_custkey % 100 AS class_code FROM orders
)"""


def water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("date"),
        epoch_us(F.col("l_shipdate")).alias("at_us"),
        F.col("l_quantity").alias("t1"),
        F.col("l_discount").alias("c1"),
        F.col("l_extendedprice").alias("p1"),
        F.col("l_tax").alias("sal"),
        (F.col("l_quantity") * F.col("l_tax")).alias("sv"),
    )


WATER_SQL = """water AS (
  SELECT l_orderkey, l_linenumber, l_shipdate AS date, epoch_us(l_shipdate) AS at_us, l_quantity AS t1, l_discount AS c1,
    l_extendedprice AS p1, l_tax AS sal, l_quantity * l_tax AS sv FROM lineitem
)"""


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event starts a five-minute recording."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("wav_id"), epoch_us(F.col("ts")).alias("wav_us"), F.to_date("ts").alias("file"))

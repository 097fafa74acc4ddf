"""The registered queries and, beside each, its SQL."""

from __future__ import annotations

import datetime
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo, labels, signal, times
from ..operators import cleaning, clips, interpolate, metadata, report, sampling, scenario
from ..sources import audio, nmea, remote, text
from . import views
from .views import AIS_SQL, META_SQL, PRIORITIES, QUIET, RADII, WATER_SQL, table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return keep


def _rounded(c: str):
    """Six digits, a little off exact halves: sums in another order then round alike."""
    return F.round(F.col(c) + 1e-9, 6).alias(c)


def _day():
    return F.col("file").cast("string").alias("file")


# -- scenarios ------------------------------------------------------------------------------------

_RADII_SQL = "radii AS (SELECT unnest([1000, 3000, 6000, 10000])::INTEGER AS r)"
_BINS_SQL = f"""WITH {AIS_SQL}, {_RADII_SQL},
spine AS (SELECT unnest(generate_series((SELECT min(at_us // 600000000) FROM ais), (SELECT max(at_us // 600000000) FROM ais))) * 600000000 AS bin_us),
c AS (
  SELECT s.bin_us, r, count(*) FILTER (distance <= r) AS n_inclusion, count(*) FILTER (distance <= r + 2000) AS n_exclusion,
    count(DISTINCT mmsi) FILTER (distance <= r + 2000) AS vessels
  FROM spine s CROSS JOIN radii LEFT JOIN ais a ON a.at_us // 600000000 * 600000000 = s.bin_us GROUP BY ALL
),
bins AS (SELECT *, CASE WHEN n_exclusion = 0 THEN 'background' WHEN vessels = 1 AND n_inclusion = n_exclusion THEN 'vessel' ELSE 'none' END AS kind FROM c)"""


def _wide(spark, sf_dir):
    m = views.ais(spark, sf_dir).select("mmsi", "at_us", "distance")
    return scenario.classify_bins(m, RADII, views.STEP_US)


def _timed(intervals: DataFrame) -> DataFrame:
    ends = {"begin": times.from_epoch_us(F.col("begin_us")), "end": times.from_epoch_us(F.col("end_us"))}
    return intervals.select("kind", "inclusion_radius", "n_bins", *[c.alias(n) for n, c in ends.items()])


def _least():
    return F.when(F.col("kind") == "background", views.LEAST["background"]).otherwise(views.LEAST["vessel"])


@query(_BINS_SQL + " SELECT r AS inclusion_radius, make_timestamp(bin_us) AS minute, n_inclusion, n_exclusion, kind FROM bins")
def minute_classification(spark, sf_dir):
    d = scenario.long_bins(_wide(spark, sf_dir), RADII)
    return d.select("inclusion_radius", times.from_epoch_us(F.col("bin_us")).alias("minute"), "n_inclusion", "n_exclusion", "kind")


def _runs_sql(source: str, name: str) -> str:
    """CTEs from (kind, r, bin_us) to the runs' bins and runs."""
    return f"""{name}_d AS (SELECT *, coalesce((bin_us - lag(bin_us) OVER w) // 600000000, 0) AS diff FROM {source} WINDOW w AS (PARTITION BY kind, r ORDER BY bin_us)),
{name}_n AS (SELECT *, CASE WHEN diff = lag(diff) OVER w THEN 0 ELSE 1 END AS new FROM {name}_d WINDOW w AS (PARTITION BY kind, r ORDER BY bin_us)),
{name}_r AS (SELECT *, sum(new) OVER (PARTITION BY kind, r ORDER BY bin_us) AS run FROM {name}_n),
{name} AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY kind, r, run) AS size FROM {name}_r) WHERE size >= CASE kind WHEN 'background' THEN 3 ELSE 2 END)"""


_GROUP_SQL = "SELECT kind, r AS inclusion_radius, count(*) AS n_bins, make_timestamp(min(bin_us)) AS begin, make_timestamp(max(bin_us) + 600000000) AS \"end\""


def _runs(spark, sf_dir, strict=False):
    bins = scenario.long_bins(_wide(spark, sf_dir), RADII).where("kind <> 'none'")
    return _timed(scenario.runs(bins, ("kind", "inclusion_radius"), views.STEP_US, _least(), strict))


@query(f"{_BINS_SQL}, open AS (SELECT kind, r, bin_us FROM bins WHERE kind <> 'none'), {_runs_sql('open', 'used')} {_GROUP_SQL} FROM used GROUP BY kind, r, run")
def scenario_runs(spark, sf_dir):
    return _runs(spark, sf_dir)


@query(f"{_BINS_SQL}, open AS (SELECT kind, r, bin_us FROM bins WHERE kind <> 'none'), {_runs_sql('open', 'used')} {_GROUP_SQL} FROM used GROUP BY kind, r, run HAVING min(diff) = 1")
def scenario_runs_strict(spark, sf_dir):
    return _runs(spark, sf_dir, strict=True)


def _cascade_sql() -> str:
    out, taken = [_BINS_SQL], []
    for r in sorted(RADII, reverse=True):
        gone = " UNION ALL ".join(f"SELECT kind, bin_us FROM used_{x}" for x in taken)
        rest = f" AND NOT EXISTS (SELECT 1 FROM ({gone}) g WHERE g.kind = b.kind AND g.bin_us = b.bin_us)" if taken else ""
        out.append(f"open_{r} AS (SELECT kind, r, bin_us FROM bins b WHERE kind <> 'none' AND r = {r}{rest})")
        out.append(_runs_sql(f"open_{r}", f"used_{r}"))
        taken.append(r)
    return ",\n".join(out) + ",\nfinal AS (" + " UNION ALL ".join(f"SELECT kind, r, run, bin_us FROM used_{r}" for r in taken) + f"), intervals AS ({_GROUP_SQL}, min(bin_us) AS begin_us, max(bin_us) + 600000000 AS end_us FROM final GROUP BY kind, r, run)"


def _intervals(spark, sf_dir):
    return scenario.cascade(_wide(spark, sf_dir), RADII, (), views.STEP_US, views.LEAST)


@query(_cascade_sql() + ' SELECT kind, inclusion_radius, n_bins, begin, "end" FROM intervals')
def scenario_intervals(spark, sf_dir):
    return _timed(_intervals(spark, sf_dir))


@query(_cascade_sql() + " SELECT kind, inclusion_radius, begin_us, event_id, mmsi, ts, round(distance, 6) AS distance FROM intervals JOIN ais ON at_us BETWEEN begin_us - 60000000 AND end_us + 60000000")
def interval_extract(spark, sf_dir):
    d = scenario.interval_messages(_intervals(spark, sf_dir), views.ais(spark, sf_dir))
    return d.select("kind", "inclusion_radius", "begin_us", "event_id", "mmsi", "ts", F.round("distance", 6).alias("distance"))


# -- cleaning -------------------------------------------------------------------------------------


@query(f"WITH {AIS_SQL} SELECT event_id, mmsi, file::VARCHAR AS file, coalesce(type_and_cargo, max(type_and_cargo) OVER (PARTITION BY file, mmsi)) AS type_and_cargo FROM ais")
def type_fill(spark, sf_dir):
    return cleaning.fill_type(views.ais(spark, sf_dir)).select("event_id", "mmsi", _day(), "type_and_cargo")


@query(f"WITH {AIS_SQL} SELECT DISTINCT event_id, mmsi, ts, round(x, 6) AS x, round(y, 6) AS y FROM ais WHERE x IS NOT NULL AND y IS NOT NULL")
def dedupe_positions(spark, sf_dir):
    d = views.ais(spark, sf_dir).select("event_id", "mmsi", "ts", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
    return cleaning.located(d.unionByName(d))


_RAW_SQL = """raw AS (SELECT event_id, CASE WHEN k % 17 = 0 THEN 4 ELSE id END AS id, k % 2 AS part_num, CASE WHEN k % 13 = 0 THEN mmsi ELSE mmsi + 316000000 END AS mmsi,
  CASE WHEN k % 7 = 0 THEN 181 ELSE x END AS x, CASE WHEN k % 11 = 0 THEN 91 ELSE y END AS y, k * 20.0::DOUBLE AS sog, cog * 2 AS cog, k * 10.0::DOUBLE AS true_heading, k % 30 AS type_and_cargo FROM ais)"""


@query(f"""WITH {AIS_SQL}, {_RAW_SQL}, picked AS (
  SELECT event_id, id, mmsi, CASE WHEN id IN (1,2,3,18,19) AND x < 181 THEN round(x, 6) END AS x, CASE WHEN id IN (1,2,3,18,19) AND y < 91 THEN round(y, 6) END AS y,
    CASE WHEN id IN (1,2,3,18,19) AND sog < 1023 THEN sog END AS sog, CASE WHEN id IN (1,2,3,18,19) AND cog < 3600 THEN round(cog, 6) END AS cog,
    CASE WHEN id IN (1,2,3,18,19) AND true_heading < 511 THEN true_heading END AS true_heading,
    CASE WHEN id IN (5,19) OR (id = 24 AND part_num = 1) THEN nullif(type_and_cargo, 0) END AS type_and_cargo
  FROM raw WHERE length(mmsi::VARCHAR) = 9 AND id IN (1,2,3,5,18,19,24))
SELECT * FROM picked WHERE coalesce(x, y, sog, cog, true_heading, type_and_cargo) IS NOT NULL""")
def sentinel_null(spark, sf_dir):
    k = F.col("k")
    raw = views.ais(spark, sf_dir).select(
        "event_id",
        F.when(k % 17 == 0, 4).otherwise(F.col("id")).alias("id"),
        (k % 2).alias("part_num"),
        F.when(k % 13 == 0, F.col("mmsi")).otherwise(F.col("mmsi") + 316000000).alias("mmsi"),
        F.when(k % 7 == 0, 181.0).otherwise(F.col("x")).alias("x"),
        F.when(k % 11 == 0, 91.0).otherwise(F.col("y")).alias("y"),
        (k * 20.0).alias("sog"),
        (F.col("cog") * 2).alias("cog"),
        (k * 10.0).alias("true_heading"),
        (k % 30).alias("type_and_cargo"),
    )
    m = cleaning.select_messages(raw)
    return m.select("event_id", "id", "mmsi", *[F.round(c, 6).alias(c) for c in ("x", "y")], "sog", F.round("cog", 6).alias("cog"), "true_heading", "type_and_cargo")


_STATIONS = (("west", -122.95, 49.03), ("east", -122.85, 49.06))


def _stations(spark):
    rows = F.array(*[F.struct(F.lit(n).alias("station"), F.lit(x).alias("sx"), F.lit(y).alias("sy")) for n, x, y in _STATIONS])
    return spark.range(1).select(F.inline(rows))


_HAVERSINE = "2 * 6371008.8::DOUBLE * asin(sqrt(least(1.0::DOUBLE, power(sin(radians(y - sy) / 2), 2) + cos(radians(sy)) * cos(radians(y)) * power(sin(radians(x - sx) / 2), 2))))"


@query(f"WITH {AIS_SQL}, s AS (SELECT * FROM (VALUES ('west', -122.95::DOUBLE, 49.03::DOUBLE), ('east', -122.85::DOUBLE, 49.06::DOUBLE)) v(station, sx, sy)) SELECT event_id, station, round(d, 3) AS metres FROM (SELECT event_id, station, {_HAVERSINE} AS d FROM ais, s) WHERE ceil(d) <= 6000")
def radius_filter(spark, sf_dir):
    d = cleaning.near_station(views.ais(spark, sf_dir), _stations(spark), 6000)
    return d.select("event_id", "station", F.round("distance_to_station", 3).alias("metres"))


def _geodesic_sql(source: str, rounds: int = 6) -> str:
    """CTEs from (sx, sy, x, y) to ``far`` with metres: Vincenty's formula, a CTE a step."""
    f, a = geo.FLATTENING, geo.EQUATOR_M
    b = a * (1 - f)
    n = lambda v: f"{v!r}::DOUBLE"
    sphere = """sqrt(power(cu2 * sin(lam), 2) + power(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS sin_s, su1 * su2 + cu1 * cu2 * cos(lam) AS cos_s,
    cu1 * cu2 * sin(lam) / nullif(sin_s, 0) AS sin_a, atan2(sin_s, cos_s) AS sigma, 1 - sin_a * sin_a AS cos2a, coalesce(cos_s - 2 * su1 * su2 / nullif(cos2a, 0), 0) AS cos_m"""
    out = [f"v0 AS (SELECT *, atan(tan(radians(sy)) * {n(1 - f)}) AS u1, atan(tan(radians(y)) * {n(1 - f)}) AS u2, sin(u1) AS su1, cos(u1) AS cu1, sin(u2) AS su2, cos(u2) AS cu2, radians(x - sx) AS gap, gap AS lam FROM {source})"]
    keep = "event_id, station, sx, sy, x, y, su1, cu1, su2, cu2, gap"
    for i in range(rounds):
        out.append(f"s{i} AS (SELECT *, {sphere}, {n(f / 16)} * cos2a * (4 + {n(f)} * (4 - 3 * cos2a)) AS k FROM v{i})")
        out.append(f"v{i + 1} AS (SELECT {keep}, gap + (1 - k) * {n(f)} * sin_a * (sigma + k * sin_s * (cos_m + k * cos_s * (2 * cos_m * cos_m - 1))) AS lam FROM s{i})")
    out.append(f"s{rounds} AS (SELECT *, {sphere}, cos2a * {n((a**2 - b**2) / b**2)} AS sq, 1 + sq / 16384 * (4096 + sq * (-768 + sq * (320 - 175 * sq))) AS ka, sq / 1024 * (256 + sq * (-128 + sq * (74 - 47 * sq))) AS kb FROM v{rounds})")
    delta = "kb * sin_s * (cos_m + kb / 4 * (cos_s * (2 * cos_m * cos_m - 1) - kb / 6 * cos_m * (4 * sin_s * sin_s - 3) * (4 * cos_m * cos_m - 3)))"
    out.append(f"far AS (SELECT event_id, station, CASE WHEN x = sx AND y = sy THEN 0 ELSE {n(b)} * ka * (sigma - {delta}) END AS metres FROM s{rounds})")
    return ",\n".join(out)


_PAIRS_SQL = f"WITH {AIS_SQL}, st AS (SELECT * FROM (VALUES ('west', -122.95::DOUBLE, 49.03::DOUBLE), ('east', -122.85::DOUBLE, 49.06::DOUBLE)) v(station, sx, sy)), p AS (SELECT event_id, station, sx, sy, x, y FROM ais, st), {_geodesic_sql('p')}"


@query(_PAIRS_SQL + " SELECT event_id, station, round(metres + 1e-7::DOUBLE, 3) AS metres FROM far")
def geodesic_distance(spark, sf_dir):
    d = views.ais(spark, sf_dir).select("event_id", "x", "y").crossJoin(F.broadcast(_stations(spark)))  # two constant rows
    far = geo.geodesic(F.col("sx"), F.col("sy"), F.col("x"), F.col("y"))
    return d.select("event_id", "station", F.round(far + 1e-7, 3).alias("metres"))


@query(_PAIRS_SQL + " SELECT event_id, station, round(metres + 1e-7::DOUBLE, 3) AS metres FROM far WHERE ceil(metres) <= 6000")
def radius_filter_geodesic(spark, sf_dir):
    d = cleaning.near_station(views.ais(spark, sf_dir), _stations(spark), 6000, geo.geodesic)
    return d.select("event_id", "station", F.round(F.col("distance_to_station") + 1e-7, 3).alias("metres"))


_DEPLOYMENTS = (("A", "1995-01-10 05:00:00", "1995-02-20 07:00:00"), ("B", "1995-02-01 00:00:00", "1995-03-15 23:00:00"), ("C", "1996-01-01 12:00:00", "1996-06-01 12:00:00"))


def _deployments(spark):
    rows = F.array(*[F.struct(F.lit(n).alias("device"), F.lit(a).cast("timestamp_ntz").alias("begin"), F.lit(b).cast("timestamp_ntz").alias("end")) for n, a, b in _DEPLOYMENTS])
    return spark.range(1).select(F.inline(rows))


_DEPLOYMENT_ROWS = ", ".join(f"('{n}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for n, a, b in _DEPLOYMENTS)


def _assign(spark, sf_dir, short_only):
    files = table(spark, sf_dir, "orders").select("o_orderkey", times.epoch_us(F.col("o_orderdate")).alias("at_us"))
    return cleaning.in_deployments(files, _deployments(spark), "at_us", short_only=short_only).select("o_orderkey", "device", "begin")


_ASSIGN_SQL = f"SELECT o_orderkey, device, begin FROM orders JOIN (VALUES {_DEPLOYMENT_ROWS}) d(device, begin, finish) ON o_orderdate BETWEEN date_trunc('day', begin) AND date_trunc('day', finish) + INTERVAL 1 DAY"


@query(_ASSIGN_SQL)
def deployment_assign(spark, sf_dir):
    return _assign(spark, sf_dir, False)


@query(_ASSIGN_SQL + " WHERE finish - begin <= INTERVAL 60 DAY")
def deployment_assign_short(spark, sf_dir):
    return _assign(spark, sf_dir, True)


@query("SELECT 'DEV_' || o_orderkey || '.txt' AS name FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def file_manifest_anti(spark, sf_dir):
    available = table(spark, sf_dir, "orders").select(F.concat(F.lit("DEV_"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("name"))
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.concat(F.lit("DEV_"), F.col("l_orderkey").cast("string"), F.lit("_parsed.json")).alias("output"))
    return cleaning.not_done(available, done, F.regexp_replace("name", r"\.txt$", ""), F.regexp_replace("output", r"_parsed\.json$", ""))


class _Archive:
    """A client of an archive that knows the deployments and a file a day of each."""

    def deployments(self, device):
        return [{"begin": a, "end": b, "latitude": 49.0, "longitude": -123.0, "depth": 100.0, "location": "strait"} for n, a, b in (*_DEPLOYMENTS, ("A", "1994-01-01 00:00:00", "1994-01-02 00:00:00"), ("B", "", ""), ("C", "1997-01-01 00:00:00", None)) if n == device]

    def list(self, request):
        begin = datetime.datetime.fromisoformat(request["begin"])
        days = (datetime.datetime.fromisoformat(request["end"]) - begin).days
        return [f"{request['device']}_{begin + datetime.timedelta(days=i):%Y%m%d}.{request['extension']}" for i in range(days + 1)]

    def fetch(self, name):
        return name.encode() * 3


_ARCHIVE_SQL = f"(VALUES {_DEPLOYMENT_ROWS}, ('A', TIMESTAMP '1994-01-01 00:00:00', TIMESTAMP '1994-01-02 00:00:00')) d(device, begin, finish)"


@query(f"SELECT device, begin, finish AS \"end\", row_number() OVER (PARTITION BY device ORDER BY begin) AS place FROM {_ARCHIVE_SQL}")
def deployments_by_begin(spark, sf_dir):
    d = remote.query_deployments(spark, ("A", "B", "C"), _Archive)
    d = d.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("begin", "end")})
    return d.select("device", "begin", "end", F.row_number().over(W.partitionBy("device").orderBy("begin")).cast("long").alias("place"))


@query(f"SELECT name, length(name) * 3 AS size FROM (SELECT DISTINCT device || '_' || strftime(day, '%Y%m%d') || '.wav' AS name FROM (SELECT device, unnest(generate_series(begin, begin + INTERVAL 1 DAY * (epoch(finish - begin)::BIGINT // 86400)::INTEGER, INTERVAL 1 DAY)) AS day FROM {_ARCHIVE_SQL}))")
def archive_fetch(spark, sf_dir):
    requests = remote.deployment_filters(remote.query_deployments(spark, ("A", "B", "C"), _Archive), "recordings", {"recordings": F.col("device")}, {"recordings": "wav"})
    names = remote.list_files(requests, _Archive, 4)
    return remote.fetch(names, _Archive, 4).select("name", F.octet_length("content").cast("long").alias("size"))


# -- tracks ---------------------------------------------------------------------------------------

_GAPS_SQL = f"""WITH {AIS_SQL}, many AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY mmsi) AS n FROM ais) WHERE n > 1),
g AS (SELECT *, lag(at_us) OVER (PARTITION BY mmsi ORDER BY at_us) AS prev_us FROM many),
gaps AS (SELECT *, at_us - prev_us AS gap_us, coalesce(at_us - prev_us > 20000000 AND at_us - prev_us <= 1200000000, false) AS fillable FROM g),
made AS (SELECT mmsi, step::INTEGER AS step, prev_us + (step * gap_us) // steps AS at_us FROM (
  SELECT mmsi, prev_us, gap_us, ceil(gap_us / 20000000)::BIGINT AS steps, unnest(generate_series(0, ceil(gap_us / 20000000)::BIGINT - 1)) AS step FROM gaps WHERE fillable))"""


def _tracks(spark, sf_dir):
    return interpolate.repeated_vessels(views.ais(spark, sf_dir))


@query(_GAPS_SQL + " SELECT event_id, mmsi, gap_us, fillable FROM gaps")
def vessel_gap_lag(spark, sf_dir):
    return interpolate.gaps(_tracks(spark, sf_dir)).select("event_id", "mmsi", "gap_us", "fillable")


@query(_GAPS_SQL + " SELECT mmsi, step, at_us FROM made")
def interpolate_steps(spark, sf_dir):
    return interpolate.exact_steps(interpolate.gaps(_tracks(spark, sf_dir)))


def _filled_sql(place: str) -> str:
    sides = ", ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN {place} END IGNORE NULLS) OVER a AS p0_{c}, last_value({c} IGNORE NULLS) OVER a AS v0_{c}, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN {place} END IGNORE NULLS) OVER b AS p1_{c}, first_value({c} IGNORE NULLS) OVER b AS v1_{c}"
        for c in ("x", "y", "sog")
    )
    values = ", ".join(
        f"round(1e-9::DOUBLE + CASE WHEN {c} IS NOT NULL THEN {c} WHEN p0_{c} IS NULL THEN NULL WHEN p1_{c} IS NULL THEN v0_{c} "
        f"ELSE v0_{c} + (v1_{c} - v0_{c}) * coalesce(({place} - p0_{c}) / nullif(p1_{c} - p0_{c}, 0), 0) END, 6) AS {c}"
        for c in ("x", "y", "sog")
    )
    return f"""{_GAPS_SQL}, u AS (SELECT mmsi, at_us, false AS is_interpolated, id, x, y, sog FROM many UNION ALL SELECT mmsi, at_us, true, NULL, NULL, NULL, NULL FROM made),
o AS (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY at_us, is_interpolated)::DOUBLE AS rn FROM u),
s AS (SELECT *, {sides}, last_value(id IGNORE NULLS) OVER a AS last_id FROM o
  WINDOW a AS (PARTITION BY mmsi ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY mmsi ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT mmsi, at_us, is_interpolated, CASE WHEN is_interpolated THEN last_id ELSE id END AS id, {values} FROM s"""


def _filled(spark, sf_dir, method):
    m = _tracks(spark, sf_dir).select("mmsi", "at_us", "id", "x", "y", "sog")
    d = interpolate.interpolated(m, ("x", "y", "sog"), ("id",), method=method)
    return d.select("mmsi", "at_us", "is_interpolated", "id", *[_rounded(c) for c in ("x", "y", "sog")])


@query(_filled_sql("rn"))
def interpolate_values(spark, sf_dir):
    return _filled(spark, sf_dir, "position")


@query(_filled_sql("at_us::DOUBLE"))
def interpolate_time_weighted(spark, sf_dir):
    return _filled(spark, sf_dir, "time")


_TRACK_SQL = f"""WITH {AIS_SQL}, o AS (SELECT event_id, mmsi, sog, cog, row_number() OVER (PARTITION BY mmsi ORDER BY at_us)::DOUBLE AS rn FROM ais),
s AS (SELECT *, last_value(CASE WHEN sog IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS p0, last_value(sog IGNORE NULLS) OVER a AS v0, first_value(CASE WHEN sog IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS p1, first_value(sog IGNORE NULLS) OVER b AS v1 FROM o
  WINDOW a AS (PARTITION BY mmsi ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY mmsi ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(_TRACK_SQL + " SELECT event_id, mmsi, round(1e-9::DOUBLE + CASE WHEN v1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * coalesce((rn - p0) / nullif(p1 - p0, 0), 0) END, 6) AS sog FROM s WHERE v0 IS NOT NULL")
def trailing_gap_drop(spark, sf_dir):
    m = views.ais(spark, sf_dir).select("event_id", "mmsi", "at_us", "sog", "cog")
    return report.track_points(m, values=("sog", "cog")).select("event_id", "mmsi", _rounded("sog"))


@query(f"WITH {AIS_SQL} SELECT 'all' AS step, count(*) AS n_rows, count(DISTINCT mmsi) AS n_vessels FROM ais UNION ALL SELECT 'typed', count(*), count(DISTINCT mmsi) FROM ais WHERE type_and_cargo IS NOT NULL UNION ALL SELECT 'near', count(*), count(DISTINCT mmsi) FROM ais WHERE distance <= 300")
def vessel_counts(spark, sf_dir):
    m = views.ais(spark, sf_dir).select("mmsi", "type_and_cargo", "distance")
    return report.vessel_counts({"all": m, "typed": m.where("type_and_cargo is not null"), "near": m.where("distance <= 300")})


# -- clips ----------------------------------------------------------------------------------------


@query(_cascade_sql() + """, i AS (SELECT *, row_number() OVER (PARTITION BY kind, inclusion_radius ORDER BY begin_us, end_us)::INTEGER - 1 AS clip_index FROM intervals),
w AS (SELECT event_id AS wav_id, epoch_us(ts) AS wav_us FROM events),
p AS (SELECT kind, inclusion_radius, clip_index, wav_id, greatest(0, floor((begin_us - wav_us) / 1000)::BIGINT) AS start_ms, least(300000, floor((end_us - wav_us) / 1000)::BIGINT) AS stop_ms
  FROM i JOIN w ON wav_us BETWEEN begin_us - 300000000 AND end_us)
SELECT * FROM p WHERE stop_ms - start_ms >= 3200""")
def clip_overlap(spark, sf_dir):
    i = clips.numbered(_intervals(spark, sf_dir), ("kind", "inclusion_radius"))
    d = clips.overlaps(i, views.recordings(spark, sf_dir).drop("file"))
    return d.select("kind", "inclusion_radius", "clip_index", "wav_id", F.col("start_ms").cast("long").alias("start_ms"), F.col("stop_ms").cast("long").alias("stop_ms"))


_PARTS_SQL = """, i AS (SELECT *, row_number() OVER (PARTITION BY kind, inclusion_radius ORDER BY begin_us, end_us)::INTEGER - 1 AS clip_index FROM intervals WHERE inclusion_radius = 6000),
w AS (SELECT event_id AS wav_id, epoch_us(ts) AS wav_us, event_type AS device FROM events),
p AS (SELECT kind, clip_index, wav_id, wav_us, device, greatest(0, floor((begin_us - wav_us) / 1000)::BIGINT) AS start_ms, least(300000, floor((end_us - wav_us) / 1000)::BIGINT) AS stop_ms
  FROM i JOIN w ON wav_us BETWEEN begin_us - 300000000 AND end_us)"""


def _parts(spark, sf_dir):
    i = clips.numbered(clips.with_radius(_intervals(spark, sf_dir), exclusion=8000), ("kind", "inclusion_radius"))
    wavs = table(spark, sf_dir, "events").select(F.col("event_id").alias("wav_id"), times.epoch_us(F.col("ts")).alias("wav_us"), F.col("event_type").alias("device"))
    return clips.overlaps(i, wavs)


@query(_cascade_sql() + _PARTS_SQL + " SELECT kind, clip_index, wav_id, start_ms, stop_ms, device || '_' || strftime(make_timestamp(wav_us + start_ms * 1000), '%Y%m%dT%H%M%S.') || lpad(((wav_us + start_ms * 1000) // 1000 % 1000)::VARCHAR, 3, '0') || 'Z_' || clip_index || '.wav' AS clip FROM p WHERE stop_ms - start_ms >= 3200")
def radius_clips(spark, sf_dir):
    d = _parts(spark, sf_dir)
    name = clips.clip_name(F.col("device"), times.from_epoch_us(F.col("wav_us") + F.col("start_ms") * 1000), F.col("clip_index"))
    return d.select("kind", "clip_index", "wav_id", F.col("start_ms").cast("long").alias("start_ms"), F.col("stop_ms").cast("long").alias("stop_ms"), name.alias("clip"))


@query(_cascade_sql() + _PARTS_SQL + " SELECT kind, clip_index, string_agg(wav_id || ':' || start_ms || ':' || stop_ms, ',' ORDER BY wav_us, wav_id::VARCHAR) AS files FROM p WHERE stop_ms - start_ms >= 3200 GROUP BY kind, clip_index")
def files_by_time(spark, sf_dir):
    found = _parts(spark, sf_dir).withColumn("name", F.col("wav_id").cast("string"))
    d = clips.ordered_files(found, ("kind", "clip_index"), "name")
    part = lambda f: F.concat_ws(":", f["name"], f["start_ms"].cast("string"), f["stop_ms"].cast("string"))
    return d.select("kind", "clip_index", F.array_join(F.transform("files", part), ",").alias("files"))


_SEGMENTS_SQL = f"""WITH {AIS_SQL}, f AS (SELECT * FROM (SELECT * REPLACE (coalesce(type_and_cargo, max(type_and_cargo) OVER (PARTITION BY file, mmsi)) AS type_and_cargo) FROM ais) WHERE type_and_cargo IS NOT NULL),
n AS (SELECT *, CASE WHEN mmsi = lag(mmsi) OVER (PARTITION BY file ORDER BY at_us) THEN 0 ELSE 1 END AS new FROM f),
r AS (SELECT *, sum(new) OVER (PARTITION BY file ORDER BY at_us) AS run FROM n),
g AS (SELECT file, run, arg_min(mmsi, at_us) AS mmsi, arg_min(type_and_cargo, at_us) AS type_and_cargo, min(at_us) AS begin_us, max(at_us) AS last_us FROM r GROUP BY file, run),
segments AS (SELECT file, mmsi, type_and_cargo, begin_us, end_us FROM (SELECT *, coalesce(lead(begin_us) OVER (PARTITION BY file ORDER BY run), last_us) AS end_us FROM g) WHERE begin_us < end_us)"""


def _segments(spark, sf_dir):
    return clips.collapse(cleaning.fill_type(views.ais(spark, sf_dir)))


@query(_SEGMENTS_SQL + " SELECT * REPLACE (file::VARCHAR AS file) FROM segments")
def segment_collapse(spark, sf_dir):
    return _segments(spark, sf_dir).withColumn("file", _day())


_MATCH_SQL = _SEGMENTS_SQL + """ SELECT s.file::VARCHAR AS file, s.mmsi, s.begin_us, s.end_us, w.event_id AS wav_id FROM segments s JOIN ais w ON w.file = s.file AND w.at_us > s.begin_us - 300000000 AND w.at_us <= s.end_us
WHERE NOT (s.type_and_cargo BETWEEN 70 AND 79 OR s.type_and_cargo IN (52, 37))"""


@query(_MATCH_SQL)
def ship_segment_match(spark, sf_dir):
    d = clips.segment_recordings(_segments(spark, sf_dir), views.recordings(spark, sf_dir))
    return d.select(_day(), "mmsi", "begin_us", "end_us", "wav_id")


@query(_MATCH_SQL + " AND s.begin_us >= w.at_us AND s.begin_us <= w.at_us + 300000000")
def ship_segment_start(spark, sf_dir):
    d = clips.segment_recordings(_segments(spark, sf_dir), views.recordings(spark, sf_dir), begin_in_recording=True)
    return d.select(_day(), "mmsi", "begin_us", "end_us", "wav_id")


@query(f"WITH {META_SQL} SELECT row_id, label FROM meta WHERE MMSI IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def clip_semi(spark, sf_dir):
    chosen = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("MMSI"))
    return views.meta(spark, sf_dir).join(chosen, "MMSI", "left_semi").select("row_id", "label")


# -- metadata -------------------------------------------------------------------------------------

_WATER_COLUMNS = ("t1", "c1", "p1", "sal", "sv")


@query(f"WITH {WATER_SQL}, day AS (SELECT at_us, count(*) AS n, " + ", ".join(f"sum({c}) AS {c}" for c in _WATER_COLUMNS) + " FROM water GROUP BY at_us) SELECT o_orderkey AS row_id, " + ", ".join(f"round(sum({c}) / sum(n) + 1e-9::DOUBLE, 6) AS {c}" for c in _WATER_COLUMNS) + " FROM orders LEFT JOIN day ON at_us BETWEEN epoch_us(o_orderdate) AND epoch_us(o_orderdate) + 259200000000 GROUP BY o_orderkey")
def ctd_mean(spark, sf_dir):
    i = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), times.epoch_us(F.col("o_orderdate")).alias("begin_us")).withColumn("end_us", F.col("begin_us") + 3 * 86_400 * times.SECOND)
    d = metadata.mean_readings(i, views.water(spark, sf_dir), _WATER_COLUMNS, 3 * 86_400 * times.SECOND, ("row_id",))
    return d.select("row_id", *[_rounded(c) for c in _WATER_COLUMNS])


@query(f"WITH {WATER_SQL} SELECT l_orderkey, l_linenumber, " + ", ".join(f"round(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 6) AS {c}_norm" for c in _WATER_COLUMNS) + " FROM water")
def ctd_minmax_norm(spark, sf_dir):
    d = metadata.normalised(views.water(spark, sf_dir), _WATER_COLUMNS)
    return d.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_norm", 6).alias(f"{c}_norm") for c in _WATER_COLUMNS])


_CLASS_SQL = "CASE WHEN class_code = 0 THEN 'background' WHEN class_code = 52 THEN 'tug' WHEN class_code BETWEEN 60 AND 69 THEN 'passengership' WHEN class_code BETWEEN 70 AND 79 THEN 'cargo' WHEN class_code BETWEEN 80 AND 89 THEN 'tanker' ELSE 'other' END"


@query(f"WITH {META_SQL} SELECT row_id, class_code, {_CLASS_SQL} AS label FROM meta")
def class_labels(spark, sf_dir):
    return metadata.labelled(views.meta(spark, sf_dir)).select("row_id", "class_code", "label")


@query(f"WITH {AIS_SQL} SELECT file::VARCHAR AS file, (arg_min(struct_pack(t := type_and_cargo, m := mmsi), at_us)).t AS type_and_cargo, (arg_min(struct_pack(t := type_and_cargo, m := mmsi), at_us)).m AS mmsi FROM ais WHERE distance <= 3000 GROUP BY file")
def first_in_range(spark, sf_dir):
    return metadata.first_vessel(views.ais(spark, sf_dir), ("file",), 3000).withColumn("file", _day())


@query(f"WITH {AIS_SQL} SELECT event_id, mmsi, c_name AS ship_name, c_nationkey AS flag FROM ais LEFT JOIN customer ON mmsi = c_custkey")
def ship_enrichment(spark, sf_dir):
    ships = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("mmsi"), F.col("c_name").alias("ship_name"), F.col("c_nationkey").alias("flag"))
    return metadata.enriched(views.ais(spark, sf_dir).select("event_id", "mmsi"), ships)


_REPORT_CLASSES = (*PRIORITIES, "6-EMPTY")


@query(f"""WITH {META_SQL}, c AS (SELECT unnest({list(_REPORT_CLASSES)}) AS label), s AS (SELECT c.label, count(DISTINCT MMSI) AS n_vessels, min(date) AS first_date, max(date) AS last_date, coalesce(sum(duration_us), 0)::BIGINT AS total_us, count(row_id) AS n_clips FROM c LEFT JOIN meta USING (label) GROUP BY c.label)
SELECT *, (total_us // 86400000000) || ' days ' || lpad((total_us // 1000000 % 86400 // 3600)::VARCHAR, 2, '0') || ':' || lpad((total_us // 1000000 % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((total_us // 1000000 % 60)::VARCHAR, 2, '0') AS duration FROM s""")
def class_report(spark, sf_dir):
    return report.class_report(views.meta(spark, sf_dir), _REPORT_CLASSES)


@query(f"""WITH {META_SQL}, c AS (SELECT unnest({list(_REPORT_CLASSES)}) AS label), s AS (SELECT c.label, count(DISTINCT MMSI) AS n, min(date) AS a, max(date) AS b, coalesce(sum(duration_us), 0)::BIGINT AS t, count(row_id) AS k FROM c LEFT JOIN meta USING (label) GROUP BY c.label)
SELECT concat_ws(' | ', label, n::VARCHAR, strftime(a, '%Y-%m-%d %H:%M:%S'), strftime(b, '%Y-%m-%d %H:%M:%S'), (t // 86400000000) || ' days ' || lpad((t // 1000000 % 86400 // 3600)::VARCHAR, 2, '0') || ':' || lpad((t // 1000000 % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((t // 1000000 % 60)::VARCHAR, 2, '0'), k::VARCHAR) AS value FROM s""")
def report_text(spark, sf_dir):
    return report.report_lines(report.class_report(views.meta(spark, sf_dir), _REPORT_CLASSES))


@query(f"""WITH {META_SQL}, {WATER_SQL}, m AS (SELECT row_id, MMSI, class_code, date, duration_us, {_CLASS_SQL} AS label FROM meta),
day AS (SELECT at_us, count(*) AS n, """ + ", ".join(f"sum({c}) AS {c}" for c in _WATER_COLUMNS) + " FROM water GROUP BY at_us), ends AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _WATER_COLUMNS) + " FROM water), j AS (SELECT m.row_id, m.MMSI, m.class_code, m.date::DATE AS date, m.duration_us / 1e6::DOUBLE AS duration_sec, m.label, " + ", ".join(f"sum({c}) / sum(n) AS {c}" for c in _WATER_COLUMNS) + " FROM m LEFT JOIN day ON at_us BETWEEN epoch_us(m.date) AND epoch_us(m.date) + 259200000000 GROUP BY ALL) SELECT row_id, MMSI, class_code, date::VARCHAR AS date, duration_sec, label, " + ", ".join(f"round({c} + 1e-9::DOUBLE, 6) AS {c}, round(({c} - lo_{c}) / nullif(hi_{c} - lo_{c}, 0) + 1e-9::DOUBLE, 6) AS {c}_norm" for c in _WATER_COLUMNS) + " FROM j, ends")
def metadata_full(spark, sf_dir):
    m = metadata.labelled(views.meta(spark, sf_dir)).withColumn("begin_us", times.epoch_us(F.col("date"))).withColumn("end_us", F.col("begin_us") + 3 * 86_400 * times.SECOND)
    w = views.water(spark, sf_dir)
    means = metadata.mean_readings(m.select("row_id", "begin_us", "end_us"), w, _WATER_COLUMNS, 3 * 86_400 * times.SECOND, ("row_id",)).drop("begin_us", "end_us")
    d = metadata.scaled(m.join(means, "row_id", "left"), w, _WATER_COLUMNS)
    return d.select("row_id", "MMSI", "class_code", F.to_date("date").cast("string").alias("date"), (F.col("duration_us") / 1e6).alias("duration_sec"), "label", *[_rounded(c) for c in _WATER_COLUMNS], *[_rounded(f"{c}_norm") for c in _WATER_COLUMNS])


# -- sampling -------------------------------------------------------------------------------------

_TOTALS_SQL = f"{META_SQL}, totals AS (SELECT label, sum(duration_us)::BIGINT AS total_us, count(*) AS n FROM meta GROUP BY label)"
_ORDER_SQL = "(row_id * 2654435761 + 42) % 2147483648, row_id"


@query(f"""WITH {_TOTALS_SQL}, b AS (SELECT *, coalesce(sum(duration_us // 1000000) OVER (PARTITION BY label ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM meta)
SELECT row_id, label, unnest(generate_series(0, duration_us // 1000000 - 1, 5)) AS sub_init FROM b WHERE duration_us >= 1000000 AND before * 1000000 <= (SELECT max(total_us) FROM totals WHERE label <> '5-LOW')""")
def chunk_metadata(spark, sf_dir):
    return sampling.chunks(views.meta(spark, sf_dir), PRIORITIES, 5, QUIET).select("row_id", "label", "sub_init")


@query(f"""WITH {_TOTALS_SQL}, b AS (SELECT *, coalesce(sum(duration_us) OVER (PARTITION BY label ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY label ORDER BY row_id) AS rn FROM meta)
SELECT row_id, label, duration_us FROM b WHERE before < (SELECT min(total_us) FROM totals) OR rn = 1""")
def undersample(spark, sf_dir):
    return sampling.undersampled(views.meta(spark, sf_dir), PRIORITIES).select("row_id", "label", "duration_us")


@query(f"""WITH {_TOTALS_SQL}, t AS (SELECT least(2 * min(total_us), max(total_us)) AS target FROM totals),
b AS (SELECT *, coalesce(sum(duration_us) OVER (PARTITION BY label ORDER BY {_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM meta)
SELECT row_id, label, unnest(generate_series(0, ((target - before - 1) // total_us)::BIGINT)) AS copy FROM b JOIN totals USING (label) CROSS JOIN t WHERE before < target""")
def oversample(spark, sf_dir):
    return sampling.oversampled(views.meta(spark, sf_dir), PRIORITIES).select("row_id", "label", "copy")


@query(f"""WITH {_TOTALS_SQL}, b AS (SELECT *, coalesce(sum(duration_us) OVER (ORDER BY {_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM meta WHERE label = '5-LOW')
SELECT row_id, label FROM b WHERE before <= (SELECT max(total_us) FROM totals WHERE label <> '5-LOW') UNION ALL SELECT row_id, label FROM meta WHERE label <> '5-LOW'""")
def background_cap(spark, sf_dir):
    return sampling.capped_background(views.meta(spark, sf_dir), PRIORITIES, QUIET).select("row_id", "label")


@query(f"""WITH {_TOTALS_SQL}, s AS (SELECT min(n) * 5 AS base FROM totals), p AS (SELECT row_id, label, row_number() OVER (ORDER BY {_ORDER_SQL}) - 1 AS position FROM meta)
SELECT row_id, label, CASE WHEN position < floor(base * 0.1) THEN 'test' WHEN position < floor(base * 0.1) + floor(base * 0.2) THEN 'validation' ELSE 'train' END AS split FROM p CROSS JOIN s""")
def split_dataset(spark, sf_dir):
    return sampling.split(views.meta(spark, sf_dir), PRIORITIES).select("row_id", "label", "split")


@query(f"""WITH {_TOTALS_SQL}, t AS (SELECT c.label, c.rank, coalesce(total_us, 0)::BIGINT AS total_us FROM (SELECT unnest({list((*PRIORITIES, '6-EMPTY', '7-EMPTY'))}) AS label, unnest(range(7)) AS rank) c LEFT JOIN totals USING (label))
SELECT (SELECT label FROM t ORDER BY total_us DESC, rank LIMIT 1) AS largest, (SELECT label FROM t ORDER BY total_us, rank LIMIT 1) AS smallest, max(total_us) AS most_us, min(total_us) AS least_us FROM t""")
def extreme_classes(spark, sf_dir):
    return sampling.extreme_classes(sampling.class_totals(views.meta(spark, sf_dir), (*PRIORITIES, "6-EMPTY", "7-EMPTY")))


@query(f"WITH {META_SQL} SELECT row_id, label FROM meta ORDER BY {_ORDER_SQL} LIMIT 51")
def bounded_head(spark, sf_dir):
    d = views.meta(spark, sf_dir).withColumn("at", sampling.shuffled(F.col("row_id")))
    return sampling.head(d, ("at", "row_id")).select("row_id", "label")


@query("SELECT o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders) WHERE i BETWEEN 101 AND 110")
def batch_slice(spark, sf_dir):
    return sampling.batch(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ("o_orderdate", "o_orderkey"), 100)


@query("SELECT o_orderkey, replace(replace(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z'), '-', ''), ':', '') AS begin, replace(replace(o_orderpriority, '-', ''), ':', '') AS plain FROM orders")
def punctuation_replace(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", times.without_punctuation(times.to_iso(F.col("o_orderdate"))).alias("begin"), times.without_punctuation(F.col("o_orderpriority")).alias("plain"))


# -- signals --------------------------------------------------------------------------------------

_FLUCTUATION_SQL = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS s, len(embedding) AS n FROM embeddings),
i AS (SELECT vec_id, label, s, n, unnest(generate_series(1, n)) AS i FROM e),
k AS (SELECT vec_id, label, s[i] AS v, list_sort([s[CASE WHEN i + d < 1 THEN 1 - (i + d) WHEN i + d > n THEN 2 * n + 1 - (i + d) ELSE i + d END] for d in [-2, -1, 0, 1, 2]])[3] AS m FROM i),
f AS (SELECT vec_id, label, stddev_pop(v - m) AS std FROM k GROUP BY vec_id, label)"""


def _fluctuations(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", signal.fluctuation(F.col("embedding"), 5).alias("std"))


@query(f"WITH {_FLUCTUATION_SQL} SELECT vec_id, label, round(std, 6) AS std FROM f")
def fluctuation_std(spark, sf_dir):
    return _fluctuations(spark, sf_dir).withColumn("std", F.round("std", 6))


@query(f"""WITH {_FLUCTUATION_SQL}, r AS (SELECT vec_id, label, round(std, 6) AS std FROM f)
SELECT vec_id, label, std, std >= (SELECT round(avg(std), 9) FROM r WHERE label = 0) AS valid FROM r WHERE label <> 0 UNION ALL SELECT vec_id, label, std, true FROM r WHERE label = 0""")
def noise_threshold(spark, sf_dir):
    return sampling.above_noise(fluctuation_std(spark, sf_dir), 0)


@query(f"""WITH {_FLUCTUATION_SQL}, r AS (SELECT vec_id, label, round(std, 6) AS std FROM f), v AS (SELECT *, label = 0 OR std >= (SELECT round(avg(std), 9) FROM r WHERE label = 0) AS valid FROM r)
SELECT vec_id, std, valid, row_number() OVER (ORDER BY valid, std, vec_id) - 1 AS position FROM v WHERE label <> 0""")
def noise_chart(spark, sf_dir):
    rows = sampling.above_noise(fluctuation_std(spark, sf_dir), 0).where("label <> 0")
    return report.bar_table(rows.select("vec_id", "std", "valid"), "std", ("vec_id",))


# -- text and bytes -------------------------------------------------------------------------------


@query("SELECT event_id, date_trunc('millisecond', ts) AS ts, '!' || event_type AS payload FROM events")
def line_filter_split(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.concat(times.to_compact(F.col("ts")), F.lit(" !"), F.col("event_type")).alias("value"))
    bad = e.select("event_id", F.lit("20240101T000000 !broken").alias("value"))
    return text.split_lines(e.unionByName(bad)).select("event_id", "ts", "payload")


@query("SELECT l_orderkey, l_linenumber, l_shipdate AS date, l_quantity AS t1, l_discount AS c1, l_extendedprice AS p1, l_tax AS sal, l_quantity * l_tax AS sv FROM lineitem")
def ctd_xml_parse(spark, sf_dir):
    w = views.water(spark, sf_dir)
    body = F.concat(*[F.concat(F.lit(f"<{c}>"), F.col(c).cast("string"), F.lit(f"</{c}>")) for c in _WATER_COLUMNS])
    line = F.concat(times.to_compact(F.col("date")), F.lit(' <?xml version="1.0"?><datapacket><data>'), body, F.lit("</data></datapacket>"))
    lines = w.select("l_orderkey", "l_linenumber", line.alias("value"))
    return text.parse_water(lines).select("l_orderkey", "l_linenumber", "date", *_WATER_COLUMNS)


def _sentences(payloads: np.ndarray, head: str = "AIVDM,1,1,,A", fill: int = 0) -> pa.Array:
    """Whole sentences of rows of payload characters."""
    n = len(payloads)
    wide = lambda x: np.tile(np.frombuffer(x.encode(), np.uint8), (n, 1))
    body = np.concatenate([wide(f"{head},"), payloads, wide(f",{fill}")], axis=1)
    sums = np.bitwise_xor.reduce(body, axis=1) if n else np.empty(0, np.uint8)
    digits = np.frombuffer(b"0123456789ABCDEF", np.uint8)
    rows = np.concatenate([wide("!"), body, wide("*"), digits[sums >> 4][:, None], digits[sums & 15][:, None]], axis=1)
    return pa.array([r.tobytes().decode() for r in rows], pa.string())


def _fixed(b: pa.RecordBatch, name: str, scale: float = 1.0, missing: float = 0) -> np.ndarray:
    return np.rint(b.column(name).cast(pa.float64()).fill_null(missing).to_numpy(zero_copy_only=False) * scale).astype(np.int64)


def _encoded(batches):
    """Sentences of (event_id, mmsi, id, x, y, sog, code) of the types 1, 3, 18, 19, 24 and, in two
    parts, 5, for the decoder to read."""
    for b in batches:
        kind, zero = _fixed(b, "id"), np.zeros(b.num_rows, np.int64)
        mmsi, sog, code = _fixed(b, "mmsi"), _fixed(b, "sog", 1, 1023), _fixed(b, "code")
        x, y = _fixed(b, "x", nmea.DEGREE) & 0xFFFFFFF, _fixed(b, "y", nmea.DEGREE) & 0x7FFFFFF
        place = [(sog, 10), (zero, 1), (x, 28), (y, 27), (zero + 900, 12), (zero + 511, 9)]
        layouts = {
            1: [(kind, 6), (zero, 2), (mmsi, 30), (zero, 12), *place, (zero, 31)],
            18: [(kind, 6), (zero, 2), (mmsi, 30), (zero, 8), *place, (zero, 35)],
            19: [(kind, 6), (zero, 2), (mmsi, 30), (zero, 8), *place, (zero, 130), (code, 8), (zero, 41)],
            5: [(kind, 6), (zero, 2), (mmsi, 30), (zero, 2), (zero, 30), (zero, 162), (code, 8), (zero, 180)],
            24: [(kind, 6), (zero, 2), (mmsi, 30), (zero + 1, 2), (code, 8), (zero, 120)],
        }
        for form, fields in layouts.items():
            own = np.flatnonzero((kind == form) | (kind == 3) & (form == 1))
            if not len(own):
                continue
            payload = nmea.encode_all([(v[own], n) for v, n in fields])
            ids = b.column("event_id").take(pa.array(own))
            if form == 5:  # two sentences, told apart by a sequence number
                yield pa.RecordBatch.from_arrays([ids, _sentences(payload[:, :56], "BSVDM,2,1,7,B")], ["event_id", "payload"])
                yield pa.RecordBatch.from_arrays([ids, _sentences(payload[:, 56:], "BSVDM,2,2,7,B")], ["event_id", "payload"])
            else:
                yield pa.RecordBatch.from_arrays([ids, _sentences(payload, "ABVDM,1,1,,B" if form == 18 else "AIVDM,1,1,,A")], ["event_id", "payload"])


def _messages(spark, sf_dir, kinds, file):
    m = views.ais(spark, sf_dir).where(F.col("id").isin(*kinds)).select("event_id", "mmsi", "id", "x", "y", "sog", (F.col("k") % 90).alias("code"))
    m = m.withColumn("id", F.when((F.col("id") == 24) & (F.col("code") % 2 == 0), 19).otherwise(F.col("id")))
    lines = m.mapInArrow(_encoded, "event_id long, payload string")
    return nmea.messages(lines.withColumn("file", file), at="event_id")


@query(f"WITH {AIS_SQL} SELECT event_id, id::INTEGER AS id, mmsi, round(x, 5) AS x, round(y, 5) AS y, sog, 90.0::DOUBLE AS cog FROM ais WHERE id IN (1, 3)")
def nmea_decode(spark, sf_dir):
    d = _messages(spark, sf_dir, (1, 3), F.lit("f"))
    return d.select("event_id", "id", "mmsi", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), F.when(F.col("sog") < 1023, F.col("sog")).alias("sog"), (F.col("cog") / 10).alias("cog"))


@query(f"""WITH {AIS_SQL}, m AS (SELECT *, CASE WHEN id = 24 AND k % 90 % 2 = 0 THEN 19 ELSE id END AS kind FROM ais WHERE id IN (5, 18, 24))
SELECT event_id, kind::INTEGER AS id, mmsi, CASE WHEN kind IN (18, 19) THEN round(x, 5) END AS x, CASE WHEN kind IN (18, 19) THEN round(y, 5) END AS y, CASE WHEN kind <> 18 THEN k % 90 END::INTEGER AS type_and_cargo FROM m""")
def nmea_decode_parts(spark, sf_dir):
    # a file an event: the two sentences of a message of type 5 meet by file, sequence and channel
    d = _messages(spark, sf_dir, (5, 18, 24), F.col("event_id").cast("string"))
    return d.select("event_id", "id", "mmsi", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), "type_and_cargo")


def _as_wav(batches):
    for b in batches:
        wavs = [audio.to_wav((np.clip(np.array(v, float), -1, 1) * 1000).astype("<i2").tobytes(), 1000) for v in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(wavs, pa.binary())], ["vec_id", "content"])


@query("SELECT vec_id, len(embedding) / 1000.0::DOUBLE AS duration_sec, 1000::INTEGER AS sample_rate, 0.02::DOUBLE AS clip_sec FROM embeddings")
def wav_clip(spark, sf_dir):
    wavs = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").mapInArrow(_as_wav, "vec_id long, content binary")
    d = wavs.withColumn("whole", audio.probe(F.col("content"))).withColumn("part", audio.probe(audio.clip(F.col("content"), F.lit(10), F.lit(30))))
    return d.select("vec_id", F.col("whole.duration_sec").alias("duration_sec"), F.col("whole.sample_rate").alias("sample_rate"), F.col("part.duration_sec").alias("clip_sec"))


_FEATURE = "'{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":['"


@query(f"""WITH {AIS_SQL} SELECT {_FEATURE} || round(k / 500.0 * 1000)::INTEGER || ',' || event_id || ']}},"properties":{{"mmsi":' || mmsi || '}}}}' AS feature FROM ais
UNION ALL SELECT {_FEATURE} || sx || ',' || sy || ']}},"properties":{{"station":"' || station || '","radius":' || r || '}}}}' FROM (VALUES ('west', -123, 49), ('east', -122, 50)) s(station, sx, sy), (SELECT unnest({list(labels.RADII)}) AS r)""")
def map_points(spark, sf_dir):
    d = views.ais(spark, sf_dir).select("mmsi", F.round(F.col("k") / 500.0 * 1000).cast("int").cast("long").alias("x"), F.col("event_id").alias("y"))
    rows = F.array(*[F.struct(F.lit(n).alias("station"), F.lit(x).cast("long").alias("sx"), F.lit(y).cast("long").alias("sy")) for n, x, y in (("west", -123, 49), ("east", -122, 50))])
    return report.map_features(d, spark.range(1).select(F.inline(rows)), labels.RADII)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

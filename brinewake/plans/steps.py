"""The whole pipeline from raw files to a labelled data set, as lazy steps over tables.

Each step takes what the earlier ones returned and returns a DataFrame; ``run`` writes the tables
that several later steps read (clean and combined messages, classified intervals, matched parts,
metadata) and nothing else.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geo, times
from ..functions.labels import CLASSES, RADII
from ..operators import cleaning, clips, interpolate, metadata, sampling, scenario
from ..operators.ranges import running_before
from ..sources import audio, nmea, sinks, text

DEPLOYMENT_KEYS = ("device", "begin")
READINGS = text.READINGS


@dataclass(frozen=True)
class Options:
    """Where the inputs are and how to read them."""

    deployments: str
    positions: str
    water: str = ""
    recordings: str = ""
    output: str = ""
    inclusion_radius: float = 15_000.0
    radii: tuple[int, ...] = RADII
    least: dict[str, int] = field(default_factory=lambda: {"background": 30, "vessel": 5})
    strict_runs: bool = False
    short_deployments_only: bool = False
    interpolation: str = "position"
    clip_radius: int | None = None
    export: bool = False
    filter_noise: bool = False
    alpha: float = 0.0
    seconds: int = 5
    validation: float = 0.2
    test: float = 0.1
    seed: int = 42


def deployments(spark: SparkSession, o: Options) -> DataFrame:
    d = text.read_deployments(spark, o.deployments)
    return d.withColumns({c: F.coalesce(times.parse_iso(F.col(c)), times.parse_compact(F.col(c))) for c in ("begin", "end")})


def parse(spark: SparkSession, o: Options) -> DataFrame:
    """Valid messages of all position files."""
    lines = text.split_lines(text.read_lines(spark, o.positions)).withColumn("at_us", times.epoch_us(F.col("ts")))
    return cleaning.select_messages(nmea.messages(lines.select("file", "at_us", "payload")))


def clean(messages: DataFrame, stations: DataFrame, o: Options) -> DataFrame:
    """Distinct located messages of each deployment within the radius, types filled in.

    A file belongs to every deployment whose days hold the time in its name.
    """
    m = cleaning.located(cleaning.fill_type(messages))
    m = m.withColumn("file_us", times.epoch_us(text.name_parts(F.col("file"))[1]))
    m = cleaning.in_deployments(m, stations, "file_us", short_only=o.short_deployments_only)
    m = m.where(geo.in_box(F.col("longitude"), F.col("latitude"), F.col("x"), F.col("y"), F.lit(o.inclusion_radius)))
    m = m.withColumn("distance", geo.geodesic(F.col("longitude"), F.col("latitude"), F.col("x"), F.col("y")))
    return m.where(F.ceil("distance") <= int(o.inclusion_radius)).drop("latitude", "longitude", "depth", "location", "end", "file_us")


def combine(cleaned: DataFrame, o: Options) -> DataFrame:
    """Tracks of vessels with more than one message, short gaps filled."""
    keys = (*DEPLOYMENT_KEYS, "mmsi")
    many = interpolate.repeated_vessels(cleaned, keys)
    return interpolate.interpolated(many, ("x", "y", "sog", "cog", "true_heading", "distance"), ("id", "type_and_cargo"), keys, o.interpolation)


def identify(combined: DataFrame, o: Options) -> DataFrame:
    """Scenario intervals of every deployment."""
    wide = scenario.classify_bins(combined.select(*DEPLOYMENT_KEYS, "mmsi", "at_us", "distance"), o.radii, times.MINUTE, DEPLOYMENT_KEYS)
    return scenario.cascade(wide, o.radii, DEPLOYMENT_KEYS, times.MINUTE, o.least, o.strict_runs)


def recordings(spark: SparkSession, o: Options) -> DataFrame:
    return audio.read_recordings(spark, o.recordings).withColumn("wav_us", times.epoch_us(F.col("start"))).drop("start")


def match(spark: SparkSession, intervals: DataFrame, o: Options) -> DataFrame:
    """Which part of which recording of the interval's own device shows which interval, for the chosen
    radius (all if none is): intervals with clip_index, path, wav_us, start_ms, stop_ms."""
    wavs = recordings(spark, o).select("device", "path", "wav_us")
    chosen = clips.with_radius(intervals, o.clip_radius)
    return clips.overlaps(clips.numbered(chosen, (*DEPLOYMENT_KEYS, "kind", "inclusion_radius")), wavs, keys=("device",))


def probed(spark: SparkSession, found: DataFrame, o: Options) -> DataFrame:
    """Adds the sample rate of each clip's recording; each recording's header is read once."""
    wavs = audio.read_recordings(spark, o.recordings).select("path", "content").join(found.select("path").distinct(), "path", "left_semi")
    return found.join(wavs.select("path", audio.probe(F.col("content"))["sample_rate"].alias("sample_rate")), "path", "left")


def clip_files(found: DataFrame, o: Options) -> DataFrame:
    """Adds ``clip``, the path of each part's own file: kind/device_time_index.wav."""
    name = clips.clip_name(F.col("device"), times.from_epoch_us(F.col("wav_us") + F.col("start_ms") * 1000), F.col("clip_index"))
    return found.withColumn("clip", F.concat_ws("/", F.lit(f"{o.output}/clips"), "kind", F.format_string("in_%05d", F.col("inclusion_radius").cast("int")), name))


def export_clips(spark: SparkSession, found: DataFrame, o: Options) -> None:
    """Write every part as a WAV file of its own.

    Recordings are read once each by the tasks that cut them: all parts of a recording meet in one row.
    """
    parts = found.groupBy("path").agg(F.collect_list(F.struct("clip", "start_ms", "stop_ms")).alias("parts"))
    wavs = audio.read_recordings(spark, o.recordings).select("path", "content").join(parts, "path")
    each = wavs.select("content", F.explode("parts").alias("p"))
    cut = each.select(F.col("p.clip").alias("name"), audio.clip(F.col("content"), F.col("p.start_ms"), F.col("p.stop_ms")).alias("content"))
    audio.write_clips(cut.select(F.substring_index("name", f"{o.output}/clips/", -1).alias("name"), "content"), f"{o.output}/clips")


def water(spark: SparkSession, o: Options) -> DataFrame:
    return text.parse_water(text.read_lines(spark, o.water)).withColumn("at_us", times.epoch_us(F.col("date")))


def describe(found: DataFrame, combined: DataFrame, readings: DataFrame, o: Options) -> DataFrame:
    """Metadata of clips: label and vessel of vessel intervals, mean readings, raw and normalised."""
    where = (*DEPLOYMENT_KEYS, "kind", "inclusion_radius", "begin_us", "end_us")
    messages = combined.select(*DEPLOYMENT_KEYS, "mmsi", "at_us", "distance", "type_and_cargo")
    inside = scenario.interval_messages(found.where("kind = 'vessel'").select(*where).distinct(), messages, keys=DEPLOYMENT_KEYS).where(F.col("distance") <= F.col("inclusion_radius"))
    vessels = inside.groupBy(*where).agg(F.min_by(F.struct("type_and_cargo", "mmsi"), "at_us").alias("v"))
    d = found.join(vessels, list(where), "left").select(*found.columns, F.when(F.col("kind") == "background", F.lit(0)).otherwise(F.col("v.type_and_cargo")).alias("class_code"), F.col("v.mmsi").alias("MMSI"))
    d = metadata.labelled(d).withColumns({"clip_begin_us": F.col("wav_us") + F.col("start_ms") * 1000, "duration_us": (F.col("stop_ms") - F.col("start_ms")) * 1000})
    d = d.withColumns({"duration_sec": F.col("duration_us") / 1e6, "date": F.to_date(times.from_epoch_us(F.col("clip_begin_us")))})
    own = ("path", *where, "clip_begin_us")
    spans = d.select(*[F.col(c).alias(f"_k_{c}") for c in own], F.col("clip_begin_us").alias("begin_us"), (F.col("clip_begin_us") + F.col("duration_us")).alias("end_us")).distinct()
    means = metadata.mean_readings(spans, readings, READINGS, 5 * times.MINUTE, [f"_k_{c}" for c in own]).drop("begin_us", "end_us")
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in own]
    d = d.join(means, functools.reduce(lambda a, b: a & b, same), "left").drop(*[f"_k_{c}" for c in own])
    return metadata.scaled(d, readings, READINGS)


def report_table(meta: DataFrame) -> DataFrame:
    """The 17 columns of the metadata file; ``path`` is the clip's own file."""
    return meta.withColumn("path", F.col("clip")).select(*[c.split(" ")[0] for c in schemas.METADATA.split(", ")])


def ordered(meta: DataFrame) -> DataFrame:
    """Adds ``row_id``, a number of its own for every clip: its place by (path, begin, kind, radius).

    Places are counted in blocks of a day, so no task walks through the table.
    """
    tie = ("path", "kind", "inclusion_radius", "device", "begin", "begin_us", "end_us")
    return running_before(meta, (), "clip_begin_us", tie, F.lit(1).cast("long"), "row_id", 86_400 * times.SECOND)


def noise_filtered(spark: SparkSession, meta: DataFrame, o: Options) -> DataFrame:
    """Metadata of chunks whose fluctuation stands out of the background's: ``std`` of each chunk of
    ``o.seconds`` from its recording, vessels below the background's mean and alpha deviations go."""
    chunks = sampling.chunks(meta, CLASSES, o.seconds)
    wavs = audio.read_recordings(spark, o.recordings).select("path", "content")
    at = F.col("start_ms") + F.col("sub_init") * 1000
    d = chunks.join(wavs, "path").withColumn("std", audio.fluctuation(audio.clip(F.col("content"), at, at + o.seconds * 1000), float(o.seconds))).drop("content")
    return sampling.above_noise(d, alpha=o.alpha).where("valid").drop("valid")


def segments(messages: DataFrame, stations: DataFrame, o: Options) -> DataFrame:
    """Ship segments of each device's files: the runs of one vessel, of types that make clips."""
    m = cleaning.fill_type(messages).withColumn("file_us", times.epoch_us(text.name_parts(F.col("file"))[1]))
    m = cleaning.in_deployments(m, stations.select(*DEPLOYMENT_KEYS, "end"), "file_us", short_only=o.short_deployments_only)
    m = m.withColumn("day", F.concat_ws("_", "device", F.date_format(times.from_epoch_us(F.col("at_us")), "yyyyMMdd")))
    return clips.collapse(m, "day")


def segment_clips(spark: SparkSession, found: DataFrame, o: Options) -> DataFrame:
    """Parts of recordings that show a ship segment of their own device and day, at least the shortest
    clip long: (day, mmsi, type, path, start_ms, stop_ms)."""
    wavs = recordings(spark, o).select(F.concat_ws("_", "device", F.date_format(times.from_epoch_us(F.col("wav_us")), "yyyyMMdd")).alias("day"), "path", "wav_us")
    d = clips.segment_recordings(found, wavs, file_col="day")
    length = clips.RECORDING_US // 1000
    d = d.withColumns({"start_ms": F.greatest(F.lit(0), F.floor((F.col("begin_us") - F.col("wav_us")) / 1000)), "stop_ms": F.least(F.lit(length), F.floor((F.col("end_us") - F.col("wav_us")) / 1000))})
    return d.where(F.col("stop_ms") - F.col("start_ms") >= clips.SHORTEST_CLIP_MS)


def balance(train: DataFrame, o: Options) -> tuple[DataFrame, DataFrame]:
    """Oversampled and undersampled training rows."""
    return sampling.oversampled(train, CLASSES, seed=o.seed), sampling.undersampled(train, CLASSES)


STEPS = ("clean", "combine", "identify", "match", "describe", "balance")


def run(spark: SparkSession, o: Options, last: str = STEPS[-1]) -> dict[str, str]:
    """The steps up to ``last``; the paths of the tables written under ``o.output``."""
    paths = {}
    upto = STEPS.index(last)

    def keep(name: str, df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        paths[name] = f"{o.output}/{name}"
        sinks.write_table(df, paths[name], by)
        return spark.read.schema(df.schema).parquet(paths[name])

    cleaned = keep("clean", clean(parse(spark, o), deployments(spark, o), o))
    if upto < 1:
        return paths
    combined = keep("combined", combine(cleaned, o))
    if upto < 2:
        return paths
    intervals = keep("intervals", identify(combined, o))
    if upto < 3 or not o.recordings:
        return paths
    found = keep("matched", clip_files(probed(spark, match(spark, intervals, o), o), o))
    if o.export:
        export_clips(spark, found, o)
    if upto < 4 or not o.water:
        return paths
    meta = keep("metadata", ordered(describe(found, combined, water(spark, o), o)))
    sinks.write_csv(report_table(meta), f"{o.output}/metadata_csv")
    paths["metadata_csv"] = f"{o.output}/metadata_csv"
    if upto < 5:
        return paths
    rows = keep("split", sampling.split(meta, CLASSES, o.validation, o.test, seed=o.seed))
    over, under = balance(rows.where("split = 'train'"), o)
    keep("train_oversampled", over)
    keep("train_undersampled", under)
    keep("chunks", sampling.chunks(meta, CLASSES, o.seconds))
    if o.filter_noise:
        keep("filtered", noise_filtered(spark, meta, o))
    return paths

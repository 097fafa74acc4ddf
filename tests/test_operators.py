import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinewake.functions import geo, labels, signal, times
from brinewake.operators import cleaning, clips, interpolate, ranges, sampling, scenario
from brinewake.sources import audio, nmea, sinks, text
from brinewake.streaming import bins

S = times.SECOND


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_geodesic_against_published_line(spark):
    deg = lambda d, m, s: d + m / 60 + s / 3600
    a = [F.lit(x) for x in (deg(144, 25, 29.5244), -deg(37, 57, 3.7203), deg(143, 55, 35.3839), -deg(37, 39, 10.1561))]
    p = [F.lit(x) for x in (3.0, 4.0, 3.0, 4.0)]
    r = one(spark, geo.geodesic(*a).alias("a"), geo.geodesic(*p).alias("same"), geo.geodesic(p[0], F.lit(None).cast("double"), p[2], p[3]).alias("null"))
    assert r["a"] == pytest.approx(54972.271, abs=5e-4)
    assert r["same"] == 0.0
    assert r["null"] is None


@pytest.mark.parametrize("x", [-123.0, 10.0])
def test_box_holds_the_circle_on_both_sides_of_90(spark, x):
    m = spark.createDataFrame([(1, x + 0.1, 49.0), (2, x, 49.05), (3, x + 5, 49.0)], "mmsi long, x double, y double")
    s = spark.createDataFrame([("s", x, 49.0)], "station string, sx double, sy double")
    assert sorted(r["mmsi"] for r in cleaning.near_station(m, s, 15000).collect()) == [1, 2]


def test_radius_is_compared_rounded_up(spark):
    m = spark.createDataFrame([(1, 999.2), (2, 1000.0), (3, 1000.1)], "mmsi long, x double").withColumn("y", F.lit(0.0))
    s = spark.createDataFrame([("s", 0.0, 0.0)], "station string, sx double, sy double")
    d = cleaning.near_station(m.withColumn("x", F.col("x") / 1e9), s, 1000, distance=lambda a, b, x, y: x * 1e9)
    assert sorted(r["mmsi"] for r in d.collect()) == [1, 2]


def test_gap_bounds(spark):
    at = [0, 20 * S, 40 * S + 1000, 1240 * S + 1000, 2440 * S + 2000]
    d = spark.createDataFrame([(7, t) for t in at], "mmsi long, at_us long")
    got = [r["fillable"] for r in interpolate.gaps(d).orderBy("at_us").collect()]
    assert got == [False, False, True, True, False]
    made = interpolate.exact_steps(interpolate.gaps(d)).count()
    assert made == 2 + 60


def test_positional_interpolation_by_hand(spark):
    d = spark.createDataFrame([(7, 0, 5, 0.0, None), (7, 60 * S, 6, 4.0, 2.0), (8, 0, 1, None, None)], "mmsi long, at_us long, id int, x double, sog double")
    got = interpolate.interpolated(d, ("x", "sog"), ("id",)).where("mmsi = 7").orderBy("at_us", "is_interpolated").collect()
    assert [r["at_us"] // S for r in got] == [0, 0, 20, 40, 60]
    assert [r["x"] for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert [r["id"] for r in got] == [5, 5, 5, 5, 6]
    assert [r["sog"] for r in got] == [None, None, None, None, 2.0]
    by_time = interpolate.interpolated(d, ("x",), ("id",), method="time").where("mmsi = 7").orderBy("at_us", "is_interpolated").collect()
    assert [r["x"] for r in by_time] == pytest.approx([0.0, 0.0, 4 / 3, 8 / 3, 4.0])


@pytest.mark.parametrize(("minutes", "want"), [([0, 1, 2, 3], [(1, 4)]), ([0, 2, 4, 6], [(2, 7)]), ([0, 1, 2, 3, 10, 12, 14, 16], [(1, 4), (12, 17)]), ([], [])])
def test_runs_take_equal_differences_and_lose_the_first_bin(spark, minutes, want):
    d = spark.createDataFrame([("b", m * times.MINUTE) for m in minutes], "k string, bin_us long")
    got = scenario.runs(d, ("k",), times.MINUTE, F.lit(3)).orderBy("begin_us").collect()
    assert [(r["begin_us"] // times.MINUTE, r["end_us"] // times.MINUTE) for r in got] == want


def test_cascade_gives_a_bin_to_the_largest_radius(spark):
    rows = [(m * times.MINUTE, 1, 50_000.0) for m in range(10)]
    d = spark.createDataFrame(rows, "at_us long, mmsi long, distance double")
    wide = scenario.classify_bins(d, (1000, 3000))
    got = scenario.cascade(wide, (1000, 3000), (), times.MINUTE, {"background": 3, "vessel": 2}).collect()
    assert {(r["kind"], r["inclusion_radius"], r["n_bins"]) for r in got} == {("background", 3000, 9)}


def test_bins_without_messages_are_background(spark):
    d = spark.createDataFrame([(0, 1, 10.0), (3 * times.MINUTE, 1, 10.0)], "at_us long, mmsi long, distance double")
    got = scenario.long_bins(scenario.classify_bins(d, (1000,)), (1000,)).orderBy("bin_us").collect()
    assert [r["kind"] for r in got] == ["vessel", "background", "background", "vessel"]
    empty = scenario.classify_bins(d.limit(0), (1000,))
    assert empty.count() == 0


def test_range_join_meets_each_pair_once(spark):
    rng = np.random.default_rng(0)
    p = [(i, int(x)) for i, x in enumerate(rng.integers(-500, 500, 60))]
    v = [(i, int(a), int(a + b)) for i, (a, b) in enumerate(zip(rng.integers(-500, 500, 40), rng.integers(-5, 200, 40), strict=True))]
    got = ranges.range_join(spark.createDataFrame(p, "p long, at long"), spark.createDataFrame(v, "v long, low long, high long"), "at", "low", "high", 37)
    want = sorted((i, j) for i, x in p for j, a, b in v if a <= x <= b)
    assert sorted((r["p"], r["v"]) for r in got.collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_running_before_equals_a_plain_window(spark):
    rng = np.random.default_rng(1)
    rows = [(str(g), int(o), i, int(v)) for i, (g, o, v) in enumerate(zip(rng.integers(0, 3, 200), rng.integers(0, 50, 200), rng.integers(0, 9, 200), strict=True))]
    got = ranges.running_before(spark.createDataFrame(rows, "g string, o long, id long, v long"), ("g",), "o", ("id",), F.col("v"), "b", 7)
    want, total = {}, {}
    for g, o, i, v in sorted(rows):
        want[i] = total.get(g, 0)
        total[g] = want[i] + v
    assert {r["id"]: r["b"] for r in got.collect()} == want


def meta(spark, rows):
    return spark.createDataFrame([(i, lab, d) for i, (lab, d) in enumerate(rows)], "row_id long, label string, duration_us long")


def test_sampling_with_an_empty_class(spark):
    m = meta(spark, [("a", 5 * S), ("a", 5 * S), ("b", 3 * S)])
    assert sampling.oversampled(m, ("a", "b", "c")).count() == 0
    assert sorted(r["row_id"] for r in sampling.undersampled(m, ("a", "b", "c")).collect()) == [0, 2]


def test_oversample_reaches_its_target(spark):
    m = meta(spark, [("a", 4 * S), ("b", 10 * S), ("b", 15 * S)])
    got = sampling.oversampled(m, ("a", "b")).collect()
    assert sum(r["label"] == "a" for r in got) == 2  # target: 4 s times min(2, 25 / 4)
    assert sum(r["duration_us"] for r in got if r["label"] == "b") >= 8 * S


def test_chunk_edges(spark):
    m = meta(spark, [("a", 0), ("a", 900_000), ("a", 10 * S), ("a", 10 * S + 500_000), ("background", 3 * S), ("background", 30 * S), ("background", 5 * S)])
    got = sampling.chunks(m, ("a", "background"), 5).orderBy("row_id", "sub_init").collect()
    assert [(r["row_id"], r["sub_init"]) for r in got] == [(2, 0), (2, 5), (3, 0), (3, 5), (4, 0), *((5, i) for i in range(0, 30, 5))]


def test_split_sizes(spark):
    m = meta(spark, [("ab"[i % 2], S) for i in range(40)])
    n = {r["split"]: r["count"] for r in sampling.split(m, ("a", "b")).groupBy("split").count().collect()}
    assert n == {"test": 4, "validation": 8, "train": 28}


def test_clip_bounds(spark):
    i = spark.createDataFrame([(10 * times.MINUTE, 20 * times.MINUTE)], "begin_us long, end_us long")
    w = spark.createDataFrame([(k, t) for k, t in enumerate([5 * times.MINUTE, 6 * times.MINUTE, 18 * times.MINUTE, 20 * times.MINUTE, 4 * times.MINUTE])], "wav_id long, wav_us long")
    got = {r["wav_id"]: (r["start_ms"], r["stop_ms"]) for r in clips.overlaps(i, w).collect()}
    assert got == {1: (240_000, 300_000), 2: (0, 120_000)}


def test_classes_and_names(spark):
    codes = {None: "other", 0: "background", 52: "tug", 60: "passengership", 69: "passengership", 70: "cargo", 89: "tanker", 90: "other", 53: "other"}
    d = spark.createDataFrame([(c,) for c in codes], "c int").select("c", labels.class_of(F.col("c")).alias("l"))
    assert {r["c"]: r["l"] for r in d.collect()} == codes
    r = one(spark, labels.scenario_key(F.lit(1000), F.lit(3000)).alias("k"), times.duration_text(F.lit(90061.9)).alias("d"))
    assert (r["k"], r["d"]) == ("in_01000_out_03000", "1 days 01:01:01")


def test_time_formats_round_trip(spark):
    ts = F.lit("2024-02-29 23:59:59.123").cast("timestamp_ntz")
    r = one(spark, times.to_compact(ts).alias("c"), times.to_iso(ts).alias("i"), (times.parse_compact(times.to_compact(ts)) == ts).alias("a"), (times.parse_iso(times.to_iso(ts)) == ts).alias("b"), (times.from_epoch_us(times.epoch_us(ts)) == ts).alias("e"), times.parse_compact(F.lit("x")).alias("bad"))
    assert (r["c"], r["i"], r["a"], r["b"], r["e"], r["bad"]) == ("20240229T235959.123Z", "2024-02-29T23:59:59.123Z", True, True, True, None)


def test_median_filter_edges(spark):
    x = [5.0, 1.0, 4.0, 2.0, 3.0]
    r = one(spark, signal.median_filter(F.array(*map(F.lit, x)), 3).alias("r"), signal.median_filter(F.array(*map(F.lit, x)), 3, "zero").alias("z"))
    assert r["r"] == [5.0, 4.0, 2.0, 3.0, 3.0] == audio.median_of(np.array(x), 3).tolist()
    assert r["z"] == [1.0, 4.0, 2.0, 3.0, 2.0]


def test_water_lines(spark):
    good = '20240101T000000.000Z <?xml version="1.0"?><datapacket><data><t1>1.5</t1><c1>2</c1><p1>3</p1><sal>4</sal><sv>5</sv></data></datapacket>'
    d = spark.createDataFrame([(good,), ("20240101T000000.000Z nothing",), (good + good,)], "value string")
    got = text.parse_water(d).collect()
    assert [tuple(r)[1:] for r in got] == [(1.5, 2.0, 3.0, 4.0, 5.0)]


def sentence(bits: str, total=1, number=1, sequence="", channel="A", size=None):
    bits += "0" * (-len(bits) % 6)
    data = "".join(chr(v + 48 if v < 40 else v + 56) for v in (int(bits[i : i + 6], 2) for i in range(0, len(bits), 6)))
    parts = [data] if total == 1 else [data[:size], data[size:]]
    out = []
    for i, p in enumerate(parts):
        body = f"AIVDM,{len(parts)},{i + 1},{sequence},{channel},{p},0"
        out.append(f"!{body}*{nmea.checksum(body):02X}")
    return out


def fields(size, *values):
    b = ["0"] * size
    for at, n, v in values:
        b[at : at + n] = list(format(v & ((1 << n) - 1), f"0{n}b"))
    return "".join(b)


def test_nmea_types(spark):
    mm = 316001234
    lines = []
    lines += sentence(fields(168, (0, 6, 1), (8, 30, mm), (50, 10, 123), (61, 28, int(-123.5 * 600000)), (89, 27, int(49.25 * 600000)), (116, 12, 900), (128, 9, 511)))
    lines += sentence(fields(424, (0, 6, 5), (8, 30, mm), (40, 30, 9074729), (232, 8, 70)), total=2, sequence="3", size=40)
    lines += sentence(fields(168, (0, 6, 18), (8, 30, mm), (46, 10, 50), (57, 28, 600000), (85, 27, -600000)))
    lines += sentence(fields(312, (0, 6, 19), (8, 30, mm), (57, 28, 1200000), (85, 27, 600000), (263, 8, 52)))
    lines += sentence(fields(168, (0, 6, 24), (8, 30, mm), (38, 2, 1), (40, 8, 60)))
    lines += sentence(fields(168, (0, 6, 24), (8, 30, mm), (38, 2, 0), (40, 8, 60)))
    lines += ["garbage", "!AIVDM,2,1,5,B,55P5TL01VIaAL@7WKO@mBplU@,0*00"]
    d = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, at_us long, payload string")
    got = {(r["id"], r["part_num"]): r for r in nmea.messages(d).collect()}
    assert sorted(k[0] for k in got) == [1, 5, 18, 19, 24, 24]
    a = got[1, None]
    assert (a["mmsi"], a["sog"], a["cog"], a["true_heading"]) == (mm, 123, 900, 511)
    assert (round(a["x"], 6), round(a["y"], 6)) == (-123.5, 49.25)
    assert (got[5, None]["type_and_cargo"], got[5, None]["imo"]) == (70, 9074729)
    assert (got[18, None]["x"], got[18, None]["y"]) == (1.0, -1.0)
    assert got[19, None]["type_and_cargo"] == 52
    assert (got[24, 1]["type_and_cargo"], got[24, 0]["type_and_cargo"]) == (60, None)
    kept = cleaning.select_messages(nmea.messages(d))
    assert sorted((r["id"], r["part_num"]) for r in kept.collect() if r["id"] == 24) == [(24, 1)]


def test_wav_clip_and_probe(spark, tmp_path):
    x = np.arange(1000, dtype="<i2")
    content = audio.to_wav(x.tobytes(), 1000)
    part = audio.slice_wav(content, 100, 350)
    with wave.open(io.BytesIO(part)) as w:
        assert np.frombuffer(w.readframes(w.getnframes()), "<i2").tolist() == list(range(100, 350))
    both = audio.join_wav([part, part])
    with wave.open(io.BytesIO(both)) as w:
        assert w.getnframes() == 500
    d = spark.createDataFrame([("A_20240101T000000.000Z.wav", bytearray(content)), ("bad.wav", bytearray(b"no"))], "name string, content binary")
    r = {x["name"]: x["p"] for x in d.select("name", audio.probe(F.col("content")).alias("p")).collect()}
    assert r["A_20240101T000000.000Z.wav"]["duration_sec"] == 1.0
    assert r["bad.wav"] is None or r["bad.wav"]["sample_rate"] is None
    audio.write_clips(d.limit(1), str(tmp_path / "wavs"))
    back = audio.read_recordings(spark, str(tmp_path / "wavs")).collect()
    assert [(b["device"], bytes(b["content"])) for b in back] == [("A", content)]


def test_lines_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("20240101T000000.000Z !AIVDM,x\nnot a line\n20240101T000000 !y\n")
    got = text.split_lines(text.read_lines(spark, str(tmp_path / "in"))).collect()
    assert [(r["file"], r["payload"]) for r in got] == [("a.txt", "!AIVDM,x")]
    d = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    for _ in range(2):
        sinks.write_new(d, str(tmp_path / "t"), "k")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    sinks.write_json(d, str(tmp_path / "j"))
    sinks.write_csv(d, str(tmp_path / "c"))
    sinks.write_text(d.select("v"), str(tmp_path / "x"))
    assert text.read_csv(spark, str(tmp_path / "c"), "k long, v string").count() == 2


def test_streaming_bins(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:10", 1, 10.0), ("2024-01-01 00:00:20", 2, 9000.0), ("2024-01-01 00:01:10", 1, 10.0), ("2024-01-01 01:00:00", 1, 10.0)], "ts string, mmsi long, distance double").withColumn("ts", F.to_timestamp("ts"))
    rows.write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "s"))
    q = bins.streaming_bins(stream, (1000, 8000)).writeStream.outputMode("append").format("memory").queryName("bins_test").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {str(r["bin"])[11:16]: (r["kind_1000"], r["kind_8000"]) for r in spark.table("bins_test").collect()}
    assert got["00:00"] == ("vessel", "none")
    assert got["00:01"] == ("vessel", "vessel")

import io
import json
import wave

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import S, fields, meta, one, sentence

from brinewake import __main__ as command
from brinewake.functions import geo, times
from brinewake.operators import cleaning, clips, report, sampling
from brinewake.sources import audio, nmea, remote, sinks, text
from brinewake.streaming import bins


class Archive:
    """A client of an archive without a network."""

    def deployments(self, device):
        rows = [("2024-02-01", "2024-02-03"), ("2024-01-01", "2024-01-02"), ("2024-03-01", ""), (None, "2024-04-01")]
        return [{"begin": a, "end": b, "latitude": 49.0, "longitude": -123.0, "depth": 10.0, "location": f"at {device}"} for a, b in rows]

    def list(self, request):
        return [f"{request['device']}_{request['begin']}.{request['extension']}", f"common.{request['extension']}"]

    def fetch(self, name):
        return name.encode()


def test_remote_deployments_listings_and_fetches(spark, tmp_path):
    found = remote.query_deployments(spark, ("H1", "H2"), Archive)
    assert found.count() == 4
    remote.write_deployments(found, str(tmp_path / "deployments"))
    back = text.read_deployments(spark, str(tmp_path / "deployments"))
    assert sorted((r["device"], r["begin"], r["location"]) for r in back.collect()) == [(d, b, f"at {d}") for d in ("H1", "H2") for b in ("2024-01-01", "2024-02-01")]
    devices, ends = {"wav": F.col("device"), "ais": "AIS9"}, {"wav": "wav", "ais": "txt"}
    wavs = remote.deployment_filters(back, "wav", devices, ends)
    positions = remote.deployment_filters(back, "ais", devices, ends)
    assert {r["device"] for r in wavs.collect()} == {"H1", "H2"}
    assert {(r["device"], r["extension"]) for r in positions.collect()} == {("AIS9", "txt")}
    names = remote.list_files(wavs, Archive, 2)
    assert sorted(r["name"] for r in names.collect()) == ["H1_2024-01-01.wav", "H1_2024-02-01.wav", "H2_2024-01-01.wav", "H2_2024-02-01.wav", "common.wav", "common.wav"]
    assert {(r["name"], bytes(r["content"])) for r in remote.fetch(names, Archive, 2).collect()} == {(r["name"], r["name"].encode()) for r in names.collect()}


def test_json_arrow_listing_and_append(spark, tmp_path):
    for d in ("json", "arrow", "csv"):
        (tmp_path / d).mkdir()
    (tmp_path / "json" / "a.json").write_text(json.dumps([{"mmsi": 1, "id": 5, "type_and_cargo": 70.0}, {"mmsi": 2, "id": 1, "x": float("nan"), "y": 49.5}]))
    got = text.read_positions(spark, str(tmp_path / "json")).orderBy("mmsi").collect()
    assert [(r["mmsi"], r["type_and_cargo"], r["x"], r["y"], r["file"]) for r in got] == [(1, 70.0, None, None, "a.json"), (2, None, None, 49.5, "a.json")]
    with pa.OSFile(str(tmp_path / "arrow" / "a.feather"), "wb") as f, pa.ipc.new_file(f, pa.schema([("k", pa.int32()), ("v", pa.string())])) as w:
        w.write(pa.record_batch([pa.array([1, 2], pa.int32()), pa.array(["x", None])], ["k", "v"]))
    got = text.read_arrow(spark, str(tmp_path / "arrow"), "k long, v string, more double").orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "x", None), (2, None, None)]
    assert [(r["name"], r["length"] > 0) for r in text.listing(spark, str(tmp_path / "arrow")).collect()] == [("a.feather", True)]
    d = spark.createDataFrame([(1, "x")], "k long, v string")
    for _ in range(2):
        sinks.append_csv(d, str(tmp_path / "csv"))
    assert text.read_csv(spark, str(tmp_path / "csv"), "k long, v string").count() == 2


def test_any_talker_is_read(spark):
    bits = fields(168, (0, 6, 1), (8, 30, 316001234), (61, 28, 600000))
    lines = [sentence(bits)[0].replace("AIVDM", t) for t in ("AIVDM", "BSVDM", "ABVDO", "SAVDM", "AIXXX")]
    d = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, at_us long, payload string")
    assert sorted(r["at_us"] for r in nmea.messages(d).collect()) == [0, 1, 2, 3]


def test_payloads_against_bits():
    """All fields of random payloads against slices of the text of their bits."""
    rng = np.random.default_rng(5)
    for size in (1, 7, 28, 52, 71):
        for _ in range(30):
            kind = int(rng.choice([1, 5, 18, 19, 24, 4]))
            bits = format(kind, "06b") + "".join(map(str, rng.integers(0, 2, 6 * size - 6)))
            payload = "".join(chr(v + 48 if v < 40 else v + 56) for v in (int(bits[i : i + 6], 2) for i in range(0, len(bits), 6)))
            fill = int(rng.integers(0, 6))
            bits = bits[: len(bits) - fill]
            got = nmea.decode(payload, fill)
            layout = nmea.LAYOUT.get(kind, {})
            if len(bits) < 38 or kind != 24 and any(a + n > len(bits) for a, n, _ in layout.values()):
                assert got is None
                continue
            for name, (a, n, signed) in {"id": (0, 6, False), "mmsi": (8, 30, False), **layout}.items():
                v = int(bits[a : a + n], 2) if a + n <= len(bits) else None
                if v is not None and signed and bits[a] == "1":
                    v -= 1 << n
                if v is not None and name in "xy":
                    v /= nmea.DEGREE
                if kind == 24 and name == "type_and_cargo" and got["part_num"] != 1:
                    v = None
                assert got[name] == v
    assert nmea.decode("\x7f" * 28) is None and nmea.decode("é" * 28) is None and nmea.decode("") is None


def test_boxes_at_the_180th_meridian_and_the_poles(spark):
    m = spark.createDataFrame([(1, -179.99, 0.0), (2, 179.99, 0.0), (3, 0.0, 0.0), (4, 10.0, 89.99), (5, -170.0, 89.99)], "mmsi long, x double, y double")
    s = spark.createDataFrame([("line", 179.995, 0.0), ("pole", 10.0, 89.999)], "station string, sx double, sy double")
    got = cleaning.near_station(m, s, 15000).collect()
    assert sorted((r["station"], r["mmsi"]) for r in got) == [("line", 1), ("line", 2), ("pole", 4), ("pole", 5)]
    far = cleaning.near_station(m, s, 15000, geo.geodesic).collect()
    assert sorted((r["station"], r["mmsi"]) for r in far) == sorted((r["station"], r["mmsi"]) for r in got)
    assert "NestedLoop" not in cleaning.near_station(m, s, 15000)._jdf.queryExecution().executedPlan().toString()
    b = one(spark, *[c.alias(n) for n, c in geo.box(F.lit(0.0), F.lit(60.0), F.lit(0.0)).items()])
    assert b["right"] == pytest.approx(2 * b["top"] - 120, rel=1e-9) and b["left"] == -b["right"]


def test_names_offsets_and_colours(spark):
    r = one(
        spark,
        times.offset_to_zulu(F.lit("2024-01-01T00:00:00+00:00")).alias("z"),
        times.zulu_to_offset(F.lit("2024-01-01T00:00:00Z")).alias("o"),
        times.without_punctuation(F.lit("2024-01-01T00:00:00.000Z")).alias("p"),
        clips.clip_name(F.lit("H1"), F.lit("2024-01-01 00:00:01").cast("timestamp_ntz"), F.lit(7)).alias("n"),
    )
    assert tuple(r) == ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00+00:00", "20240101T000000.000Z", "H1_20240101T000001.000Z_7.wav")
    assert report.colour_ramp(3) == ["#0000ff", "#80007f", "#ff0000"] and report.colour_ramp(1) == ["#0000ff"] and report.colour_ramp(0) == []


def test_map_has_points_and_circles(spark):
    m = spark.createDataFrame([(1, -123.0, 49.0)], "mmsi long, x double, y double")
    s = spark.createDataFrame([("H1", -123.5, 49.5)], "station string, sx double, sy double")
    got = [json.loads(r["feature"]) for r in report.map_features(m, s, (1000, 3000)).collect()]
    assert [g["properties"] for g in got] == [{"mmsi": 1}, {"station": "H1", "radius": 1000}, {"station": "H1", "radius": 3000}]
    assert [g["geometry"]["coordinates"] for g in got] == [[-123.0, 49.0], [-123.5, 49.5], [-123.5, 49.5]]


def test_audio_from_the_end_joined_and_fluctuating(spark):
    x = np.arange(1000, dtype="<i2")
    content = audio.to_wav(x.tobytes(), 1000)
    frames = lambda c: np.frombuffer(wave.open(io.BytesIO(c)).readframes(10**6), "<i2").tolist()
    assert frames(audio.slice_wav(content, -200)) == list(range(800, 1000))
    assert frames(audio.slice_wav(content, 100, -850)) == list(range(100, 150))
    parts = [audio.slice_wav(content, 0, 3), audio.slice_wav(content, 500, 502)]
    d = spark.createDataFrame([(1, [bytearray(p) for p in parts]), (2, []), (3, None)], "k long, parts array<binary>")
    got = {r["k"]: r["w"] for r in d.select("k", audio.joined(F.col("parts")).alias("w")).collect()}
    assert frames(bytes(got[1])) == [0, 1, 2, 500, 501] and got[2] is None and got[3] is None
    rng = np.random.default_rng(0)
    y = rng.integers(-500, 500, 400).astype("<i2")
    w = spark.createDataFrame([(bytearray(audio.to_wav(y.tobytes(), 1000)),)], "content binary")
    std = w.select(audio.fluctuation(F.col("content"), 4.0).alias("s")).first()["s"]
    assert std == pytest.approx(float(np.std(y - audio.median_of(y.astype(float), 5))))


def test_extremes_heads_batches_and_noise(spark):
    m = meta(spark, [("b", 5 * S), ("a", 5 * S), ("c", 1 * S)])
    r = sampling.extreme_classes(sampling.class_totals(m, ("a", "b", "c", "d"))).first()
    assert (r["largest"], r["smallest"]) == ("a", "d")
    rows = spark.range(100).select((F.lit(99) - F.col("id")).alias("id"))
    assert [r["id"] for r in sampling.head(rows, ("id",)).collect()] == list(range(51))
    assert [r["id"] for r in sampling.batch(rows, ("id",), 20).collect()] == list(range(21, 31))
    assert [r["id"] for r in sampling.batch(rows, ("id",), 95).collect()] == list(range(96, 100))
    d = spark.createDataFrame([(1, "background", 1.0), (2, "background", 3.0), (3, "cargo", 2.0), (4, "cargo", 1.9), (5, "tug", None)], "id long, label string, std double")
    got = {r["id"]: r["valid"] for r in sampling.above_noise(d).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False}
    assert {r["id"] for r in sampling.above_noise(d, alpha=1.0).where("valid").collect()} == {1, 2}
    bars = report.bar_table(sampling.above_noise(d).where("label <> 'background'"), "std", ("id",))
    assert {(r["id"], r["position"]) for r in bars.collect()} == {(4, 0), (3, 1)}


def test_stream_keeps_each_message_once(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:10", 1), ("2024-01-01 00:00:10", 1), ("2024-01-01 00:00:11", 1)], "ts string, mmsi long").withColumn("ts", F.to_timestamp("ts"))
    rows.write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "s"))
    q = bins.streaming_dedup(stream, ("ts", "mmsi")).writeStream.outputMode("append").format("memory").queryName("dedup_test").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("dedup_test").count() == 2


def test_command_line_options():
    o, last = command.options(["--deployments", "d", "--positions", "p", "--output", "o", "--radii", "1000", "2000", "--least-vessel", "7", "--clip-radius", "1000", "--export", "--steps", "match"])
    assert (o.deployments, o.radii, o.least, o.clip_radius, o.export, o.strict_runs, last) == ("d", (1000, 2000), {"background": 30, "vessel": 7}, 1000, True, False, "match")
    with pytest.raises(SystemExit):
        command.options(["--positions", "p"])

import pytest
from test_operators import fields, sentence

from brinewake import __main__ as command
from brinewake.plans import steps
from brinewake.sources import audio, text


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Two stations 0.01 degrees apart, at the same time: half an hour without vessels in range, then
    one tug near both."""
    path = tmp_path_factory.mktemp("raw")
    for d in ("deployments", "ais", "water", "wav"):
        (path / d).mkdir()
    for device, x in (("HYD1", -123.5), ("HYD2", -123.49)):
        (path / "deployments" / f"{device}.csv").write_text(f"begin,end,latitude,longitude,depth,location\n2024-01-01T00:00:00.000Z,2024-01-02T00:00:00.000Z,49.0,{x},100,strait\n")
        for m in range(0, 60, 5):
            (path / "wav" / f"{device}_20240101T00{m:02d}00.000Z.wav").write_bytes(audio.to_wav(b"\1\0\0\0" * 1500, 10))
    lines = []
    for minute in range(60):
        x = -123.5 + (0.1 if minute < 40 else 0.003)
        for s in (0, 30):
            bits = fields(168, (0, 6, 1), (8, 30, 316001234), (50, 10, 100), (61, 28, int(x * 600000)), (89, 27, 49 * 600000), (116, 12, 900), (128, 9, 90))
            lines.append(f"20240101T00{minute:02d}{s:02d}.000Z {sentence(bits)[0]}")
    kind = sentence(fields(168, (0, 6, 24), (8, 30, 316001234), (38, 2, 1), (40, 8, 52)))[0]
    lines.append(f"20240101T000001.000Z {kind}")
    lines.append("broken line")
    (path / "ais" / "AIS1_20240101T000000.000Z.txt").write_text("\n".join(lines))
    xml = "".join(f'20240101T00{m:02d}00.000Z <?xml version="1.0"?><datapacket><data><t1>{m}</t1><c1>2</c1><p1>3</p1><sal>4</sal><sv>5</sv></data></datapacket>\n' for m in range(60))
    (path / "water" / "CTD1_20240101T000000.000Z.txt").write_text(xml)
    return path


def options(raw, out, **more):
    return steps.Options(str(raw / "deployments"), str(raw / "ais"), str(raw / "water"), str(raw / "wav"), str(out), radii=(1000, 3000), **more)


def test_from_raw_files_to_balanced_metadata(spark, raw, tmp_path):
    o = options(raw, tmp_path, export=True, filter_noise=True)
    paths = steps.run(spark, o)
    read = lambda name: spark.read.parquet(paths[name]).collect()
    got = sorted((r["device"], r["kind"], r["inclusion_radius"], r["n_bins"]) for r in read("intervals"))
    assert [g[:3] for g in got] == [(d, k, 3000) for d in ("HYD1", "HYD2") for k in ("background", "vessel")]
    assert all(g[3] >= (30 if g[1] == "background" else 15) for g in got)
    meta = read("metadata")
    # an interval is shown by its own device's recordings only
    assert meta and all(r["path"].rsplit("/", 1)[1].startswith(r["device"] + "_") for r in meta)
    assert len({r["row_id"] for r in meta}) == len(meta) == len(read("matched"))
    assert {r["label"] for r in meta} == {"background", "tug"}
    assert {r["MMSI"] for r in meta if r["label"] == "tug"} == {316001234}
    assert all(0 <= r["t1_norm"] <= 1 and r["c1_norm"] is None for r in meta if r["t1"] is not None)
    assert {r["sample_rate"] for r in meta} == {10} and all(0 < r["duration_sec"] <= 300 for r in meta)
    table = text.read_table(spark, paths["metadata_csv"], "metadata")
    assert {(r["label"], r["MMSI"]) for r in table.collect()} == {(r["label"], r["MMSI"]) for r in meta}
    assert table.columns == ["label", "duration_sec", "path", "sample_rate", "class_code", "date", "MMSI", "t1", "c1", "p1", "sal", "sv", "t1_norm", "c1_norm", "p1_norm", "sal_norm", "sv_norm"]
    assert table.count() == len(meta)
    # every clip is a file of its length
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_path}/clips").select("path", audio.probe("content")["duration_sec"].alias("s")).collect()
    assert {r["path"].removeprefix("file:"): pytest.approx(r["s"], abs=0.1) for r in files} == {r["clip"]: r["duration_sec"] for r in meta}
    assert {r["split"] for r in read("split")} <= {"train", "test", "validation"}
    chunks, kept = read("chunks"), read("filtered")
    assert len(chunks) > 0 and len(kept) <= len(chunks)
    assert {r["label"] for r in kept} >= {"background"}


def test_one_radius_and_one_step_can_be_chosen(spark, raw, tmp_path):
    argv = ["--deployments", str(raw / "deployments"), "--positions", str(raw / "ais"), "--recordings", str(raw / "wav"), "--output", str(tmp_path), "--radii", "1000", "3000", "--clip-radius", "1000", "--steps", "match"]
    paths = command.main(argv)
    assert list(paths) == ["clean", "combined", "intervals", "matched"]
    assert spark.read.parquet(paths["matched"]).count() == 0  # the cascade gave all bins to 3000


def test_ship_segments_to_clips(spark, raw, tmp_path):
    o = options(raw, tmp_path)
    stations = steps.deployments(spark, o)
    found = steps.segments(steps.clean(steps.parse(spark, o), stations, o).select("file", "at_us", "mmsi", "type_and_cargo"), stations, o)
    got = found.collect()
    assert sorted((r["day"], r["mmsi"], r["type_and_cargo"]) for r in got) == [(f"{d}_20240101", 316001234, 52) for d in ("HYD1", "HYD2")]
    tugs = steps.segment_clips(spark, found, o)
    assert tugs.count() == 0  # type 52 makes no clips
    ferries = steps.segment_clips(spark, found.withColumn("type_and_cargo", found["type_and_cargo"] + 8), o).collect()
    assert ferries and all(r["day"].split("_")[0] in text_name(r["path"]) and r["stop_ms"] - r["start_ms"] >= 3200 for r in ferries)


def text_name(path):
    return path.rsplit("/", 1)[1]

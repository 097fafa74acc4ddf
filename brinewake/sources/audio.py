"""WAV files as tables: header probe, partial read, clips, fluctuation, writing."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import file_name, name_parts

_DTYPES = {1: np.uint8, 2: np.int16, 4: np.int32}


def read_recordings(spark: SparkSession, path: str) -> DataFrame:
    """(path, device, start, content) of WAV files; drop ``content`` and it is never read."""
    device, start = name_parts(file_name(F.col("path")))
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path).select("path", device.alias("device"), start.alias("start"), "content")


def slice_wav(content: bytes, start_ms: int = 0, stop_ms: int | None = None) -> bytes:
    """The WAV bytes between two offsets; only those frames are decoded.  A negative offset counts
    from the end, and none is the end."""
    with wave.open(io.BytesIO(content)) as w:
        rate, n = w.getframerate(), w.getnframes()
        place = lambda ms: min(n, max(0, ms * rate // 1000 + (n if ms < 0 else 0)))
        a, b = place(start_ms), n if stop_ms is None else place(stop_ms)
        w.setpos(a)
        return to_wav(w.readframes(max(0, b - a)), rate, w.getnchannels(), w.getsampwidth())


def to_wav(frames: bytes, rate: int, channels: int = 1, width: int = 2) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(frames)
    return out.getvalue()


def join_wav(parts: list[bytes]) -> bytes:
    """One WAV of several of the same form."""
    with wave.open(io.BytesIO(parts[0])) as w:
        form = w.getframerate(), w.getnchannels(), w.getsampwidth()
    frames = []
    for p in parts:
        with wave.open(io.BytesIO(p)) as w:
            frames.append(w.readframes(w.getnframes()))
    return to_wav(b"".join(frames), *form)


def probe(content: Column) -> Column:
    """struct(duration_sec, sample_rate), from the header; NULL if it is no WAV."""

    @F.pandas_udf("duration_sec double, sample_rate int")
    def header(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = []
            for c in s:
                try:
                    with wave.open(io.BytesIO(c)) as w:
                        rows.append((w.getnframes() / w.getframerate(), w.getframerate()))
                except (wave.Error, EOFError, TypeError, ZeroDivisionError):
                    rows.append((None, None))
            yield pd.DataFrame(rows, columns=["duration_sec", "sample_rate"]).astype({"sample_rate": "Int32", "duration_sec": float})

    return header(content)


def clip(content: Column, start_ms: Column, stop_ms: Column) -> Column:
    """WAV bytes of a part."""

    @F.pandas_udf("binary")
    def cut(c: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else slice_wav(x, int(i), int(j)) for x, i, j in zip(c, a, b, strict=True)])

    return cut(content, start_ms, stop_ms)


def joined(contents: Column) -> Column:
    """One WAV of an array of WAVs of the same form, in the array's order; NULL of an empty one."""

    @F.pandas_udf("binary")
    def join(s: pd.Series) -> pd.Series:
        return pd.Series([join_wav(list(x)) if x is not None and len(x) else None for x in s])

    return join(contents)


def median_of(x: np.ndarray, kernel: int) -> np.ndarray:
    """Running median with reflected edges, over a sliding view."""
    half = kernel // 2
    padded = np.pad(x, (half, kernel - half - 1), mode="symmetric")
    return np.sort(np.lib.stride_tricks.sliding_window_view(padded, kernel), axis=1)[:, kernel // 2]


def fluctuation(content: Column, kernel_ms: float) -> Column:
    """Population deviation of the signal above its median filter of ``kernel_ms``."""

    @F.pandas_udf("double")
    def deviation(s: pd.Series) -> pd.Series:
        out = []
        for c in s:
            with wave.open(io.BytesIO(c)) as w:
                x = np.frombuffer(w.readframes(w.getnframes()), _DTYPES[w.getsampwidth()]).astype(float)
                out.append(float(np.std(x - median_of(x, int(kernel_ms * w.getframerate() / 1000) + 1))) if len(x) else None)
        return pd.Series(out, dtype=float)

    return deviation(content)


def write_clips(clips: DataFrame, folder: str) -> None:
    """Write (name, content) rows as files, one each, from the executors.

    ``folder`` must be a path that all executors share; a file appears whole or not at all.
    """

    def save(rows) -> None:
        import os
        import uuid

        for r in rows:
            path = os.path.join(folder, r["name"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            temporary = f"{path}.{uuid.uuid4().hex}.tmp"
            with open(temporary, "wb") as f:
                f.write(r["content"])
            os.replace(temporary, path)

    clips.select("name", "content").foreachPartition(save)

"""Decoding of AIS sentences (ITU-R M.1371 field layout).

Sentences of one message are brought together by (file, sequence id, channel) with DataFrame
operations; the six-bit payloads of an Arrow batch are decoded together, as matrices of bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: (first bit, bits, signed) of the fields of each message id
_POSITION_A = {"sog": (50, 10, False), "x": (61, 28, True), "y": (89, 27, True), "cog": (116, 12, False), "true_heading": (128, 9, False)}
_POSITION_B = {"sog": (46, 10, False), "x": (57, 28, True), "y": (85, 27, True), "cog": (112, 12, False), "true_heading": (124, 9, False)}
LAYOUT = {
    1: _POSITION_A,
    2: _POSITION_A,
    3: _POSITION_A,
    5: {"imo": (40, 30, False), "type_and_cargo": (232, 8, False)},
    18: _POSITION_B,
    19: {**_POSITION_B, "type_and_cargo": (263, 8, False)},
    24: {"part_num": (38, 2, False), "type_and_cargo": (40, 8, False)},
}
DEGREE = 600_000.0
FIELDS = {"id": pa.int32(), "part_num": pa.int32(), "mmsi": pa.int64(), "x": pa.float64(), "y": pa.float64(), "sog": pa.float64(), "cog": pa.float64(), "true_heading": pa.float64(), "type_and_cargo": pa.int32(), "imo": pa.int64()}
DDL = "id int, part_num int, mmsi long, x double, y double, sog double, cog double, true_heading double, type_and_cargo int, imo long"


def _field(bits: np.ndarray, first: int, n: int, signed: bool = False) -> np.ndarray:
    """A field of all rows of a (row, bit) matrix."""
    v = bits[:, first : first + n].astype(np.int64) @ (np.int64(1) << np.arange(n - 1, -1, -1, dtype=np.int64))
    return v - (v >> (n - 1) << n) if signed else v


def decode_all(payloads: list[str | None], fills: list[int]) -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Of all payloads: which are valid, the fields, and which of those are present.

    Payloads of one length become one matrix of bits, and each field of each message id is a product
    with it; one that is no payload, or too short for its id, is not valid.
    """
    count = len(payloads)
    keep = np.zeros(count, bool)
    values = {n: np.zeros(count, np.float64 if n in "xy" else np.int64) for n in FIELDS}
    known = {n: np.zeros(count, bool) for n in FIELDS}
    forms: dict[tuple[int, int], list[int]] = {}
    for i, (p, fill) in enumerate(zip(payloads, fills, strict=True)):
        if p and p.isascii():
            forms.setdefault((len(p), fill), []).append(i)
    for (length, fill), rows in forms.items():
        size = 6 * length - fill
        if size < 38 or fill < 0:
            continue
        rows = np.array(rows)
        v = np.frombuffer("".join(payloads[i] for i in rows).encode(), np.uint8).reshape(-1, length).astype(np.int16) - 48
        v = np.where(v > 40, v - 8, v)
        valid = ((v >= 0) & (v < 64)).all(1)
        rows, v = rows[valid], v[valid].astype(np.uint8)
        bits = np.unpackbits(v[:, :, None], axis=2)[:, :, 2:].reshape(len(v), 6 * length)
        kinds = _field(bits, 0, 6)
        for kind in np.unique(kinds):
            at = np.flatnonzero(kinds == kind)
            own, some = rows[at], bits[at]
            layout = {n: place for n, place in LAYOUT.get(int(kind), {}).items() if place[0] + place[1] <= size}
            if kind != 24 and len(layout) < len(LAYOUT.get(int(kind), {})):
                continue
            keep[own] = True
            found = {"id": kinds[at], "mmsi": _field(some, 8, 30)} | {n: _field(some, *place) for n, place in layout.items()}
            for n, x in found.items():
                values[n][own] = x / DEGREE if n in "xy" else x
                known[n][own] = found["part_num"] == 1 if kind == 24 and n == "type_and_cargo" else True
    return keep, values, known


def decode(payload: str, fill: int = 0) -> dict | None:
    """Fields of one payload; None if it is no payload or too short for its id."""
    keep, values, known = decode_all([payload], [fill])
    if not keep[0]:
        return None
    kind = int(values["id"][0])
    return {n: values[n][0].item() if known[n][0] else None for n in ("id", "mmsi", *LAYOUT.get(kind, {}))}


def encode_all(fields: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """(row, character) payload bytes of rows of fields given as (values, bits); whole characters."""
    bits = np.concatenate([(np.asarray(v, np.int64)[:, None] >> np.arange(n - 1, -1, -1)) & 1 for v, n in fields], axis=1)
    v = bits.reshape(len(bits), -1, 6) @ (1 << np.arange(5, -1, -1))
    return np.where(v < 40, v + 48, v + 56).astype(np.uint8)


def checksum(body: str) -> int:
    x = 0
    for b in body.encode():
        x ^= b
    return x


def sentences(lines: DataFrame, text: str = "payload", file: str = "file") -> DataFrame:
    """Adds the fields of a sentence of any talker: total, number, sequence, channel, data, fill."""
    parts = F.split(F.regexp_extract(text, r"^![A-Z]{2}VD[MO],([^*]*)", 1), ",")
    d = lines.withColumn("_p", parts).where(F.size("_p") == 6)
    number = lambda i: F.get("_p", F.lit(i)).try_cast("int")
    return d.select("*", number(0).alias("total"), number(1).alias("number"), F.get("_p", F.lit(2)).alias("sequence"), F.get("_p", F.lit(3)).alias("channel"), F.get("_p", F.lit(4)).alias("data"), F.coalesce(number(5), F.lit(0)).alias("fill")).drop("_p")


def messages(lines: DataFrame, at: str = "at_us", text: str = "payload", file: str = "file") -> DataFrame:
    """(file, at, decoded fields) of lines (file, at, text).  Incomplete and corrupt messages go.

    A message of several sentences begins at its first; parts of one sequence id that repeat over
    time are told apart by counting first parts.
    """
    s = sentences(lines, text, file)
    one = s.where("total = 1").select(file, at, "data", "fill")
    w = W.partitionBy(file, "sequence", "channel").orderBy(at, "number")
    many = s.where("total > 1").withColumn("turn", F.sum(F.when(F.col("number") == 1, 1).otherwise(0)).over(w))
    many = many.groupBy(file, "sequence", "channel", "turn").agg(F.min(at).alias(at), F.array_sort(F.collect_list(F.struct("number", "data", "fill"))).alias("parts"), F.max("total").alias("total"))
    many = many.where((F.size("parts") == F.col("total")) & (F.get("parts", F.lit(0))["number"] == 1))
    many = many.select(file, at, F.concat_ws("", F.col("parts.data")).alias("data"), F.element_at("parts", -1)["fill"].alias("fill"))
    every = one.unionByName(many)

    def run(batches):
        for b in batches:
            keep, values, known = decode_all(b.column(2).to_pylist(), b.column(3).to_pylist())
            fields = [pa.array(values[n], mask=~known[n]).cast(k) for n, k in FIELDS.items()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *fields], [file, at, *FIELDS]).filter(pa.array(keep))

    types = {f.name: f.dataType.simpleString() for f in every.schema}
    return every.mapInArrow(run, f"`{file}` {types[file]}, `{at}` {types[at]}, {DDL}")

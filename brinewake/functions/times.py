"""Time arithmetic that is the same for TIMESTAMP_NTZ in any session time zone, and text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPACT_IN = "yyyyMMdd'T'HHmmss.SSS'Z'"
COMPACT = "yyyyMMdd'T'HHmmss.SSS'Z'"
ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SECOND = 1_000_000
MINUTE = 60 * SECOND


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp's wall clock."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return (days * 86_400 + F.hour(ts).cast("long") * 3_600 + F.minute(ts).cast("long") * 60) * SECOND + seconds


def from_epoch_us(us: Column) -> Column:
    """The TIMESTAMP_NTZ of ``epoch_us``."""
    seconds = (us.cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def floor_us(us: Column, step: int) -> Column:
    return us - F.pmod(us, F.lit(step))


def parse_compact(text: Column) -> Column:
    """``20200131T235959.123Z`` to TIMESTAMP_NTZ, NULL if malformed."""
    return F.try_to_timestamp(text, F.lit(COMPACT_IN)).cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(ISO_MS)).cast("timestamp_ntz")


def to_compact(ts: Column) -> Column:
    return F.date_format(ts, COMPACT)


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_MS)


def day_floor(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def day_after(ts: Column) -> Column:
    """Floored to midnight, plus a day."""
    return F.date_add(F.to_date(ts), 1).cast("timestamp_ntz")


def offset_to_zulu(text: Column) -> Column:
    return F.replace(text, F.lit("+00:00"), F.lit("Z"))


def zulu_to_offset(text: Column) -> Column:
    return F.replace(text, F.lit("Z"), F.lit("+00:00"))


def without_punctuation(text: Column) -> Column:
    """``2020-01-31T23:59:59.123Z`` to ``20200131T235959.123Z``: dashes and colons go."""
    return F.translate(text, "-:", "")


def duration_text(seconds: Column) -> Column:
    """Seconds to ``N days HH:MM:SS``."""
    s = F.floor(seconds).cast("long")
    part = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.floor(s / 86_400).cast("string"), F.lit(" days "), part(F.floor(s % 86_400 / 3_600)), F.lit(":"), part(F.floor(s % 3_600 / 60)), F.lit(":"), part(s % 60))

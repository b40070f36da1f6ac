"""Nanosecond clocks. Times are bigint nanoseconds throughout; Spark's timestamps stop at microseconds."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS = 1_000_000_000


def epoch_ns(ts: Column) -> Column:
    """Nanoseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (the session's zone is UTC)."""
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000)


def tick_offset(k: Column, fps: Fraction) -> Column:
    """Offset of tick ``k``: k * 1e9 / fps, rounded half to even."""
    scaled = (k.cast("bigint") * F.lit(NANOS * fps.denominator)).cast("double")
    return F.rint(scaled / F.lit(float(fps.numerator))).cast("bigint")


def stamp_ns(seconds: Column, nanos: Column) -> Column:
    """Header stamps: seconds and nanoseconds, widened before they are multiplied."""
    return seconds.cast("bigint") * F.lit(NANOS) + nanos.cast("bigint")


def seconds_since(ns: Column, origin: Column) -> Column:
    return (ns - origin) / F.lit(1e9)


def frame_number(seconds: Column, fps: float) -> Column:
    """The frame at a time, rounded half to even."""
    return F.rint(seconds * F.lit(float(fps))).cast("bigint")


def missing_frames(gap: Column, median: Column, tail: bool = False) -> Column:
    """How many frames a gap swallowed, 1 at least; at the end of a stream no frame closes the gap."""
    whole = F.rint(gap / median)
    return F.greatest(F.lit(1), whole if tail else whole - 1).cast("bigint")


def session_name(ts: Column, counter: Column) -> Column:
    """Directory names of recordings: local time to microseconds and a three-digit counter."""
    return F.concat(F.date_format(ts, "yyyyMMdd_HHmmss_SSSSSS"), F.lit("_"), F.format_string("%03d", counter))


def utc_iso(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")

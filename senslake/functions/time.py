"""Time parsing and conversion as Column expressions (SCL1-7, SCL13-15)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_US = {"us": 1, "ms": 1_000, "s": 1_000_000, "min": 60_000_000, "T": 60_000_000,
             "h": 3_600_000_000, "H": 3_600_000_000, "D": 86_400_000_000, "d": 86_400_000_000}


def duration_us(spec: str) -> int:
    """'10D' / '90min' / '1h' / '500us' -> microseconds (plan-time)."""
    m = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", spec)
    if not m or m.group(2) not in _UNITS_US:
        raise ValueError(f"bad duration {spec!r}")
    return int(m.group(1)) * _UNITS_US[m.group(2)]


def iso_to_utc(s: Column) -> Column:
    """SCL1: ISO-8601 string with 'Z' or an offset -> UTC instant (NTZ).

    Strings without an offset are read as UTC. Unparsable -> null.
    """
    return F.try_to_timestamp(s).cast("timestamp_ntz")


def has_offset(s: Column) -> Column:
    """True when an ISO string carries 'Z' or a +hh:mm / -hh:mm offset."""
    return s.rlike(r"(Z|[+-]\d{2}:?\d{2})$")


def known_zone(tz: Column) -> Column:
    """``tz`` if the JVM knows the zone, else null: an invalid name then fails
    its own device (no timezone), never the batch."""
    from pyspark.sql import SparkSession
    jvm = SparkSession.active()._jvm
    names = sorted(jvm.java.time.ZoneId.getAvailableZoneIds())
    return F.when(tz.isin(names) | tz.rlike(r"^(UTC|GMT)?[+-](0[0-9]|1[0-7]):[0-5][0-9]$"), tz)


def local_to_utc(s: Column, tz: Column) -> Column:
    """SCL2: offset-less local wall time in IANA zone ``tz`` -> UTC (NTZ)."""
    ntz = F.try_to_timestamp(s).cast("timestamp_ntz")
    return F.to_utc_timestamp(ntz.cast("timestamp"), known_zone(tz)).cast("timestamp_ntz")


def recorded_at(s: Column, tz: Column) -> Column:
    """Air-sensor record time: offset/Z honoured; else localised when a zone
    is known; else taken as UTC."""
    return (F.when(s.isNull() | (F.trim(s) == ""), F.lit(None).cast("timestamp_ntz"))
            .when(has_offset(s), iso_to_utc(s))
            .when(tz.isNotNull(), local_to_utc(s, tz))
            .otherwise(iso_to_utc(s)))


def shift_offset(ts: Column, hours: int, minutes: int = 0) -> Column:
    """SCL3: local time at fixed offset +hh:mm -> UTC."""
    return ts - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(minutes), F.lit(0))


def header_offset_minutes(header: Column) -> Column:
    """Offset in minutes parsed from a 'Date (UTC+05:30)' header; 0 if absent."""
    sign = F.when(F.regexp_extract(header, r"UTC([+-])", 1) == "-", -1).otherwise(1)
    hh = F.regexp_extract(header, r"UTC[+-](\d{1,2})", 1).try_cast("int")
    mm = F.coalesce(F.regexp_extract(header, r"UTC[+-]\d{1,2}:?(\d{2})", 1).try_cast("int"), F.lit(0))
    return F.coalesce(sign * (hh * 60 + mm), F.lit(0))


def local_midnight_utc(d: Column, tz: Column) -> tuple[Column, Column]:
    """SCL4: local midnight of date ``d`` in ``tz`` and the next local
    midnight, both as UTC (NTZ). DST days are 23 or 25 hours long."""
    tz = known_zone(tz)
    start = F.to_utc_timestamp(d.cast("timestamp"), tz).cast("timestamp_ntz")
    end = F.to_utc_timestamp(F.date_add(d, 1).cast("timestamp"), tz).cast("timestamp_ntz")
    return start, end


def seconds_str(s: Column) -> Column:
    """SCL5: duration string '1860s' -> 1860 (int); bad -> null."""
    return F.regexp_replace(s, "s$", "").try_cast("int")


def civil_date(y: Column, m: Column, d: Column) -> Column:
    """SCL6: {year, month, day} -> date; null when any part is missing."""
    ts = F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0))
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), F.to_date(ts))


def date_chunks(start: Column, end: Column, days: int) -> Column:
    """SCL13: [start, end] -> array<struct<chunk_start, chunk_end>> of at most ``days`` days."""
    starts = F.sequence(start, end, F.expr(f"INTERVAL {days} DAYS"))
    return F.transform(starts, lambda s: F.struct(
        s.alias("chunk_start"), F.least(F.date_add(s, days - 1), end).alias("chunk_end")))


def pull_range(start: Column, end: Column) -> tuple[Column, Column]:
    """SCL14: a device without a configured start pulls only the day before ``end``."""
    return F.coalesce(start, F.date_sub(end, 1)), end


def open_until(until: Column) -> Column:
    """SCL15: open-ended range end (null -> far future)."""
    return F.coalesce(until, F.lit("9999-12-31").cast("date"))

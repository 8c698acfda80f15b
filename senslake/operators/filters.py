"""Row filters (FLT1-7). All are plain predicates, so Catalyst pushes them
into the Parquet scan when they touch stored columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bound(value) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def date_range(df: DataFrame, start=None, end=None, ts: str = "datetime") -> DataFrame:
    """FLT1: inclusive [start, end] on ``ts``; None leaves a side open.
    A frame without ``ts`` passes through. A date-only ``end`` is that day's
    midnight (so the rest of that day is excluded)."""
    if ts not in df.columns:
        return df
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= _bound(start))
    if end is not None:
        cond = cond & (F.col(ts) <= _bound(end))
    return df.where(cond)


def half_open_days(df: DataFrame, start, end, ts: str = "recorded_at") -> DataFrame:
    """FLT5: ``start <= ts < end + 1 day`` (the API window, also the
    incremental-load filter)."""
    s = F.lit(str(start)).cast("date").cast("timestamp_ntz")
    e = F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp_ntz")
    return df.where((F.col(ts) >= s) & (F.col(ts) < e))


def valid_coordinates(lat: Column, lon: Column, either_zero: bool = False) -> Column:
    """FLT2: both present and not exactly (0, 0). ``either_zero`` applies the
    stricter rule that rejects a row when any one axis is 0.0."""
    present = lat.isNotNull() & lon.isNotNull()
    if either_zero:
        return present & (lat != 0) & (lon != 0)
    return present & ~((lat == 0) & (lon == 0))


def drop_nulls(df: DataFrame, how: str = "any", subset=None) -> DataFrame:
    """FLT6: dropna(how, subset)."""
    return df.dropna(how=how, subset=list(subset) if subset else None)


def required_fields(df: DataFrame, fields) -> DataFrame:
    """FLT7: one row counting violations of each required (non-null) field."""
    return df.agg(F.count("*").alias("rows"),
                  *[F.sum(F.col(f).isNull().cast("long")).alias(f"{f}_missing") for f in fields])


def allowed_values(c: Column, values) -> Column:
    """FLT3 / FLT4: membership test used for routing and checks."""
    return c.isin(list(values))

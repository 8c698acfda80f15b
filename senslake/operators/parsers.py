"""EXT1: device type -> parser registry.

A parser takes the raw ingests of its device type (one DataFrame, all
devices at once) and returns ``{table_name: DataFrame}``. Raw rows of
unregistered types are reported, not parsed; parse errors are rows with an
``error`` column, isolated per device by the load step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Parser = Callable[[DataFrame], dict]
PARSERS: dict[str, Parser] = {}


def register_parser(device_type: str):
    def deco(fn: Parser) -> Parser:
        PARSERS[device_type] = fn
        return fn
    return deco


@register_parser("wearable")
def _wearable(raw: DataFrame) -> dict:
    from senslake.operators import normalize as N
    from senslake.session import materialize
    from senslake.sources import payloads
    # Five tables come from the points: they are landed once, not parsed five times.
    pts = materialize(raw.sparkSession, payloads.wearable_points(raw, profile=True), "points")
    return {"readings": N.readings(pts), "sleep_sessions": N.sleep_sessions(pts),
            "sleep_stages": N.sleep_stages(pts), "exercise_sessions": N.exercise_sessions(pts),
            "profile": N.profile(pts.where("data_type = 'profile'").withColumnRenamed("point", "section"))}


@register_parser("air")
def _air(raw: DataFrame) -> dict:
    from senslake.operators import air
    from senslake.sources import payloads
    return {"air_readings": air.with_location(air.project(payloads.air_records(raw)), keep_axes=False)}


def unregistered(raw: DataFrame) -> DataFrame:
    """Raw ingests per device type that no parser handles (reported, skipped)."""
    return (raw.where(~F.col("device_type").isin(list(PARSERS)))
            .groupBy("device_type").agg(F.count("*").alias("ingests")))

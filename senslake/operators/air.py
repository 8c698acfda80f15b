"""Air-sensor normalisation (PRJ20-26): records -> typed wide readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from senslake.functions.time import recorded_at
from senslake.registry import AIR_REGISTRY

SENSOR_COLUMNS = [name for name, _, _ in AIR_REGISTRY.values()]


def project(records: DataFrame, tz: str = "timezone", keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ20: registry rename/project; missing keys -> null; time parsed
    (offset honoured, offset-less localised with the device zone). ``error``:
    a value that does not cast, or no readable time (the key may not be null).
    ``keep`` names further columns of ``records`` to carry."""
    cols = [F.col(raw).cast(typ).alias(name) if raw in records.columns
            else F.lit(None).cast(typ).alias(name)
            for raw, (name, typ, _) in AIR_REGISTRY.items()]
    tz_c = F.col(tz) if tz in records.columns else F.lit(None).cast("string")
    keep = [c for c in ("ingest_id", "pulled_at", "point_pos", *keep) if c in records.columns]
    time = recorded_at(F.col("date"), tz_c)
    error = F.when(time.isNull(), F.concat(F.lit("unreadable time: "), F.coalesce("date", F.lit("none"))))
    if "bad_fields" in records.columns:
        error = F.when(F.col("bad_fields").isNotNull(), F.concat(F.lit("bad value: "), F.col("bad_fields"))).otherwise(error)
    return records.select("device_id", time.alias("recorded_at"),
                          F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
                          *cols, *keep, error.alias("error"))


def ewkt_point(lat: Column, lon: Column) -> Column:
    """PRJ21: 'SRID=4326;POINT(lon lat)'; null when either axis is null."""
    return F.when(lat.isNotNull() & lon.isNotNull(),
                  F.concat(F.lit("SRID=4326;POINT("), lon.cast("string"), F.lit(" "),
                           lat.cast("string"), F.lit(")")))


def with_location(readings: DataFrame, keep_axes: bool = True) -> DataFrame:
    out = readings.withColumn("location", ewkt_point(F.col("latitude"), F.col("longitude")))
    return out if keep_axes else out.drop("latitude", "longitude")


def charging_state(s: Column) -> tuple[Column, Column]:
    """PRJ24: 'yes' -> (True, False); 'cd' -> (False, True); else (False, False)."""
    v = F.lower(F.trim(F.coalesce(s, F.lit(""))))
    return v == "yes", v == "cd"


def motion_flag(s: Column) -> Column:
    return F.lower(F.trim(F.coalesce(s, F.lit("")))) == "yes"


def to_number(s: Column) -> Column:
    """PRJ25: blank / 'nan' / unparsable -> null, else a double."""
    t = F.trim(s)
    return F.when((t == "") | (F.lower(t) == "nan"), F.lit(None).cast("double")) \
        .otherwise(t.try_cast("double"))

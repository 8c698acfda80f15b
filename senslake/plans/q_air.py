"""Registered queries: air-sensor payloads, coordinates, MAC mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from senslake.functions.text import normalize_mac
from senslake.operators import air, stats
from senslake.operators.filters import valid_coordinates
from senslake.operators.joins import maybe_broadcast
from senslake.plans import model
from senslake.plans.registry import query, rounded
from senslake.plans.sql_common import AEV, AIR_SENSORS, DEVICES, with_
from senslake.sinks import load as L
from senslake.sources import payloads

_A = with_(DEVICES, AEV)


def records(spark, sf_dir):
    return payloads.air_records(model.air_raw(spark, sf_dir))


def air_readings(spark, sf_dir):
    return air.with_location(air.project(records(spark, sf_dir)))


@query("src2_air_records", sql=_A + """
SELECT ingest_id, device_id, point_pos, ts AS recorded_at FROM arec
""")
def src2_air_records(spark, sf_dir):
    """Air payloads -> one row per merged_data record (position kept)."""
    r = air.project(records(spark, sf_dir))
    return r.select("ingest_id", "device_id", F.col("point_pos").cast("int").alias("point_pos"),
                    "recorded_at")


@query("prj20_air_project", sql=_A + f"""
SELECT device_id, ts AS recorded_at, latitude, longitude, {AIR_SENSORS} FROM arec
""")
def prj20_air_project(spark, sf_dir):
    """24 raw keys -> standard typed columns; missing keys -> null."""
    r = air.project(records(spark, sf_dir))
    return rounded(r.select("device_id", "recorded_at", "latitude", "longitude", *air.SENSOR_COLUMNS))


@query("prj21_point_build", sql=_A + """
SELECT device_id, ts AS recorded_at,
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL
            THEN 'SRID=4326;POINT(' || CAST(longitude AS VARCHAR) || ' ' || CAST(latitude AS VARCHAR) || ')' END
       AS location
FROM arec
""")
def prj21_point_build(spark, sf_dir):
    """EWKT point 'SRID=4326;POINT(lon lat)', null when an axis is missing."""
    return air_readings(spark, sf_dir).select("device_id", "recorded_at", "location")


@query("flt2_valid_coordinates", sql=_A + """
SELECT 'documented' AS rule,
       count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL
                        AND NOT (latitude = 0 AND longitude = 0)) AS valid, count(*) AS rows FROM arec
UNION ALL
SELECT 'either_axis_zero',
       count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL
                        AND latitude <> 0 AND longitude <> 0), count(*) FROM arec
""")
def flt2_valid_coordinates(spark, sf_dir):
    """Rows kept by the coordinate filter: only exact (0,0) rejected
    (documented rule) vs any zero axis rejected (stricter rule)."""
    r = air.project(records(spark, sf_dir))
    lat, lon = F.col("latitude"), F.col("longitude")
    rules = {"documented": False, "either_axis_zero": True}
    one = r.agg(F.count("*").alias("rows"), *[F.count(F.when(valid_coordinates(lat, lon, strict), 1)).alias(rule) for rule, strict in rules.items()])
    return one.selectExpr("stack(2, 'documented', documented, 'either_axis_zero', either_axis_zero) AS (rule, valid)", "rows")


@query("scl2_local_to_utc", sql=_A + """
SELECT device_id, timezone, ts AS recorded_at FROM arec WHERE date_form = 'local'
""")
def scl2_local_to_utc(spark, sf_dir):
    """Offset-less local times localised with the device zone, then UTC."""
    rec = records(spark, sf_dir)
    local = rec.where(~F.col("date").rlike(r"(Z|[+-]\d{2}:?\d{2})$"))
    return air.project(local, keep=("timezone",)).select("device_id", "timezone", "recorded_at")


@query("jn5_mac_device_map", sql=_A + """
, pay AS (
  SELECT DISTINCT ingest_id, device_id,
         CASE WHEN device_id % 11 = 0 THEN 'FF:' || substr(mac, 4, 14) ELSE mac END AS mac
  FROM arec)
SELECT p.ingest_id, replace(upper(p.mac), ':', '') AS mac_norm, d.device_id AS resolved_device_id,
       CASE WHEN d.device_id IS NULL THEN 'UNKNOWN_DEVICE' ELSE 'mapped' END AS status
FROM pay p LEFT JOIN devices d ON replace(upper(d.mac), ':', '') = replace(upper(p.mac), ':', '')
""")
def jn5_mac_device_map(spark, sf_dir):
    """Payload MAC (normalised) -> registered device; unknown MACs flagged."""
    raw = model.air_raw(spark, sf_dir)
    mac = F.get_json_object("payload", "$.mac")
    p = raw.select("ingest_id", normalize_mac(mac).alias("mac_norm"))
    dev = model.devices(spark, sf_dir).select(F.col("device_id").alias("resolved_device_id"),
                                             normalize_mac(F.col("mac")).alias("mac_norm"))
    j = p.join(maybe_broadcast(dev), "mac_norm", "left")
    return j.select("ingest_id", "mac_norm", "resolved_device_id",
                    F.when(F.col("resolved_device_id").isNull(), "UNKNOWN_DEVICE")
                    .otherwise("mapped").alias("status"))


@query("scl10_mac_normalise", sql=with_(DEVICES) + """
SELECT device_id, mac, replace(replace(upper(mac), ':', ''), '-', '') AS mac_norm FROM devices
""")
def scl10_mac_normalise(spark, sf_dir):
    """MAC addresses without ':' / '-', upper case."""
    d = model.devices(spark, sf_dir)
    return d.select("device_id", "mac", normalize_mac(F.col("mac")).alias("mac_norm"))


@query("agg10_gps_fix_ratio", sql=_A + """
SELECT device_id, count(CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 1 END) AS with_fix,
       count(*) AS rows,
       round(count(CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 1 END) / count(*), 6) AS fix_ratio
FROM arec GROUP BY 1
""")
def agg10_gps_fix_ratio(spark, sf_dir):
    """Share of rows with a GPS fix (a location) per device."""
    return rounded(stats.gps_fix_ratio(air_readings(spark, sf_dir), ["device_id"]))


_NULL_FIELDS = ["latitude", "longitude", "pm05_num", "pm_size", "satellites_fixed", "aqs"]


@query("agg19_null_profile", sql=_A + """
SELECT count(*) AS rows, f.field,
       CASE f.field WHEN 'latitude' THEN count(*) - count(latitude) WHEN 'longitude' THEN count(*) - count(longitude)
                    WHEN 'pm05_num' THEN count(*) - count(pm05_num) WHEN 'pm_size' THEN count(*) - count(pm_size)
                    WHEN 'satellites_fixed' THEN count(*) - count(satellites_fixed)
                    ELSE count(*) - count(aqs) END AS nulls
FROM arec, (VALUES ('latitude'), ('longitude'), ('pm05_num'), ('pm_size'), ('satellites_fixed'), ('aqs')) f(field)
GROUP BY f.field
""")
def agg19_null_profile(spark, sf_dir):
    """Null count per record field over all air records."""
    return stats.null_profile(air.project(records(spark, sf_dir)), _NULL_FIELDS)


@query("snk2_upsert_air", sql=_A + f"""
SELECT device_id, ts AS recorded_at, {AIR_SENSORS},
       CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL
            THEN 'SRID=4326;POINT(' || CAST(longitude AS VARCHAR) || ' ' || CAST(latitude AS VARCHAR) || ')' END
       AS location, ingest_id
FROM arec QUALIFY row_number() OVER (PARTITION BY device_id, ts ORDER BY pulled_at DESC, point_pos DESC) = 1
""")
def snk2_upsert_air(spark, sf_dir):
    """Air readings upserted on (device_id, recorded_at): repeated records
    collapse to the latest pull / last position."""
    r = air.with_location(air.project(records(spark, sf_dir)), keep_axes=False)
    key = list(L.TABLES["air_readings"].key)
    merged = L.latest_per_key(r, key, ["pulled_at", "point_pos"])
    return rounded(merged.select("device_id", "recorded_at", *air.SENSOR_COLUMNS, "location", "ingest_id"))

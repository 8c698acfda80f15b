"""Registered queries: legacy multi-sensor export (JSON blob) parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from senslake.operators import legacy as G
from senslake.plans import model
from senslake.plans.registry import query, rounded
from senslake.plans.sql_common import AEV, DEVICES, LEGACY, with_

_L = with_(DEVICES, AEV, LEGACY)


def _cells(spark, sf_dir):
    e = model.air_events(spark, sf_dir)
    rec = model.air_record()
    pts = e.select("timezone", rec["lat"].alias("latitude"), rec["lon"].alias("longitude"))
    return G.grid_timezones(pts)


def standardized(spark, sf_dir):
    return G.standardize(model.legacy_export(spark, sf_dir), _cells(spark, sf_dir))


def tables(spark, sf_dir):
    return G.split_tables(standardized(spark, sf_dir))


def _v(expr, name, ok="ok"):
    return f"CASE WHEN {ok} THEN {expr} END AS \"{name}\""


_LEAVES = [("value / 3", "pm.pm1_0_atm_ug_m3"), ("value", "pm.pm2_5_atm_ug_m3"),
           ("value * 1.5", "pm.pm10_atm_ug_m3"), ("CAST(k * 7 AS BIGINT)", "pm.pm0_3_um_count"),
           ("CAST(k * 3 AS BIGINT)", "pm.pm2_5_um_count"), ("CAST(k * 2 AS BIGINT)", "pm.pm10_um_count"),
           ("value * 1.1", "pm.pm2_5_cf1"), ("value / 10", "dht.temp_c"), ("CAST(k AS BIGINT)", "dht.hum_pct"),
           ("1000.0 + k / 10.0::DOUBLE", "bme.press_hpa"), ("k / 1000.0::DOUBLE", "gas.tvoc_ppm"),
           ("CAST(k + 2 AS BIGINT)", "gas.nox_index"), ("latitude", "gps.lat"), ("longitude", "gps.lon"),
           ("CAST(10 + k AS BIGINT)", "gps.alt_m"), ("CAST(k % 12 + 3 AS BIGINT)", "gps.sat_view"),
           ("CAST(k % 12 AS BIGINT)", "gps.sat_fix"), ("CAST(k % 7 AS BIGINT)", "gps.position_err"),
           ("k / 2.0::DOUBLE", "sys.cpu_pct"), ("40.0 + k / 10.0::DOUBLE", "sys.cpu_temp"),
           ("k / 100.0::DOUBLE", "sys.load_1"), ("CAST(512 AS BIGINT)", "sys.mem_total"),
           ("'10.0.0.' || CAST(device_id % 250 AS VARCHAR)", "net.local_ip")]


def _r(expr, name):
    if expr.startswith("CAST") or expr.startswith("'"):
        return _v(expr, name)
    return _v(f"round({expr}, 6)", name)


@query("src8_json_blob_expand", sql=_L + f"""
SELECT strftime(datetime, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", device,
       {', '.join(_r(e, n) for e, n in _LEAVES)}
FROM leg
""")
def src8_json_blob_expand(spark, sf_dir):
    """JSON-in-text column -> one typed column per leaf (dotted names); the
    leaf schema comes from one aggregate; unparsable blobs give nulls."""
    e = model.legacy_export(spark, sf_dir)
    return rounded(G.expand_json(e, "data"))


@query("agg15_json_column_detect", sql=_L + """
SELECT 'timestamp' AS "column", count(*) AS non_null, 0 AS json_values, false AS is_json FROM leg
UNION ALL SELECT 'device', count(*), 0, false FROM leg
UNION ALL SELECT 'data', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE ok) > count(*) * 0.5 FROM leg
""")
def agg15_json_column_detect(spark, sf_dir):
    """Share of values parsing as a JSON object/array, per text column
    (all rows examined)."""
    return G.json_column_shares(model.legacy_export(spark, sf_dir)).select(
        "column", F.col("non_null").cast("long").alias("non_null"),
        F.col("json_values").cast("long").alias("json_values"), "is_json")


@query("agg16_time_column_detect", sql=_L + """
SELECT 'timestamp' AS "column",
       round(1 + 3.0 * count(*) / count(*) + 2.0 * count(*) / count(*) + count(*) / count(*), 6) AS score
FROM leg
""")
def agg16_time_column_detect(spark, sf_dir):
    """Time-column legitimacy scores after expansion (name, ISO share, zone
    suffix share, fill rate; native timestamps score +5)."""
    x = G.expand_json(model.legacy_export(spark, sf_dir), "data")
    return rounded(G.time_column_scores(x))


@query("agg17_latlon_detect", sql=_L + """
SELECT 'latitude' AS role, CASE WHEN min(latitude) >= -90 AND max(latitude) <= 90 THEN 'gps.lat' END AS "column"
FROM leg
UNION ALL
SELECT 'longitude', CASE WHEN min(longitude) >= -180 AND max(longitude) <= 180 THEN 'gps.lon' END FROM leg
""")
def agg17_latlon_detect(spark, sf_dir):
    """Latitude / longitude columns by name keyword and value range."""
    x = G.expand_json(model.legacy_export(spark, sf_dir), "data")
    lat, lon = G.latlon_columns(x)
    return x.sparkSession.createDataFrame([("latitude", lat), ("longitude", lon)], "role string, column string")


@query("jn9_coord_timezone", sql=_L + """
SELECT device, datetime, latitude, longitude, timezone FROM leg_tz
""")
def jn9_coord_timezone(spark, sf_dir):
    """Timezone by coordinates via a 1-degree grid-cell lookup table built
    from registered devices' positions (a join instead of a per-row call)."""
    s = standardized(spark, sf_dir)
    return s.select("device", "datetime", "latitude", "longitude", "timezone")


@query("prj29_pm_table", sql=_L + """
SELECT device, datetime, round(value / 3, 6) AS pm1_0_ugm3_atm, round(value, 6) AS pm2_5_ugm3_atm,
       round(value * 1.5, 6) AS pm10_ugm3_atm, CAST(k * 7 AS BIGINT) AS pm0_3_um_count,
       CAST(k * 3 AS BIGINT) AS pm2_5_um_count, CAST(k * 2 AS BIGINT) AS pm10_um_count,
       round(value * 1.1, 6) AS pm2_5_ugm3_cf
FROM (SELECT * REPLACE (CASE WHEN ok THEN value END AS value, CASE WHEN ok THEN k END AS k) FROM leg)
""")
def prj29_pm_table(spark, sf_dir):
    """PM table: mass (atm), particle counts and CF=1 groups by keyword rules."""
    return rounded(tables(spark, sf_dir)["pm"])


def _nullable(sql_body):
    return _L + sql_body.replace("FROM leg", "FROM (SELECT * REPLACE (CASE WHEN ok THEN value END AS value, "
                                             "CASE WHEN ok THEN k END AS k, CASE WHEN ok THEN device_id END "
                                             "AS device_id) FROM leg)")


@query("prj30_weather", sql=_nullable("""
SELECT device, datetime, round(value / 10, 6) AS temp_c, CAST(k AS BIGINT) AS hum_pct,
       round(1000.0 + k / 10.0::DOUBLE, 6) AS press_hpa FROM leg
"""))
def prj30_weather(spark, sf_dir):
    """Weather table: temperature, humidity, pressure by keyword rules."""
    return rounded(tables(spark, sf_dir)["weather"])


@query("prj30_gas", sql=_nullable("""
SELECT device, datetime, CAST(k + 2 AS BIGINT) AS nox_index, round(k / 1000.0::DOUBLE, 6) AS tvoc_ppm FROM leg
"""))
def prj30_gas(spark, sf_dir):
    """Gas table: TVOC and NOx columns by keyword rules."""
    return rounded(tables(spark, sf_dir)["gas"])


@query("prj30_sat", sql=_nullable("""
SELECT device, datetime, CAST(k % 7 AS BIGINT) AS position_error_m, CAST(k % 12 AS BIGINT) AS sat_used_count,
       CAST(k % 12 + 3 AS BIGINT) AS sat_view_count FROM leg
"""))
def prj30_sat(spark, sf_dir):
    """Satellite table: fix count, satellites in view, position error."""
    return rounded(tables(spark, sf_dir)["sat"])


@query("prj31_sys", sql=_nullable("""
SELECT device, datetime, round(k / 2.0::DOUBLE, 6) AS cpu_pct, round(40.0 + k / 10.0::DOUBLE, 6) AS cpu_temp_c,
       round(k / 100.0::DOUBLE, 6) AS load_1min, CASE WHEN k IS NOT NULL THEN CAST(512 AS BIGINT) END AS mem_total_mb
FROM leg
"""))
def prj31_sys(spark, sf_dir):
    """System / power table: CPU, load, memory and power-rail columns."""
    return rounded(tables(spark, sf_dir)["sys"])


@query("prj31_net", sql=_nullable("""
SELECT device, datetime, '10.0.0.' || CAST(device_id % 250 AS VARCHAR) AS local_ip FROM leg
"""))
def prj31_net(spark, sf_dir):
    """Network table: local / public address columns."""
    return tables(spark, sf_dir)["net"]


@query("prj32_gis_table", sql=_L + """
SELECT device, datetime, longitude, latitude, timezone,
       CASE WHEN ok THEN CAST(10 + k AS BIGINT) END AS altitude FROM leg_tz
""")
def prj32_gis_table(spark, sf_dir):
    """GIS table: datetime, longitude, latitude, timezone, altitude; all rows kept."""
    return tables(spark, sf_dir)["gis"]


@query("prj33_multi_table_split", sql=_L + """
SELECT t.name AS table_name, count(*) AS rows, t.cols AS columns
FROM leg, (VALUES ('gis', 6), ('pm', 9), ('weather', 5), ('gas', 4), ('sat', 5), ('sys', 6), ('net', 3)) t(name, cols)
GROUP BY t.name, t.cols
""")
def prj33_multi_table_split(spark, sf_dir):
    """One standardised frame split into seven sub-tables: rows and columns each."""
    out = None
    for name, t in tables(spark, sf_dir).items():
        c = t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows",
                                                     F.lit(len(t.columns)).alias("columns"))
        out = c if out is None else out.unionByName(c)
    return out


@query("jn4_pm_submerge", sql=_L + """
SELECT device, datetime, round(value / 3, 6) AS pm1_0_ugm3_atm, round(value, 6) AS pm2_5_ugm3_atm,
       round(value * 1.5, 6) AS pm10_ugm3_atm, CAST(k * 7 AS BIGINT) AS pm0_3_um_count,
       CAST(k * 3 AS BIGINT) AS pm2_5_um_count, CAST(k * 2 AS BIGINT) AS pm10_um_count, round(value * 1.1, 6) AS pm2_5_ugm3_cf
FROM (SELECT * REPLACE (CASE WHEN ok THEN value END AS value, CASE WHEN ok THEN k END AS k) FROM leg)
""")
def jn4_pm_submerge(spark, sf_dir):
    """PM mass, count and CF=1 sub-tables, all their columns, merged back on (device, datetime): both left
    joins that the legacy flow performs, null-safe, in one exchange."""
    from senslake.operators.joins import merge_on_time
    from senslake.session import materialize
    s = materialize(spark, standardized(spark, sf_dir), "legacy")
    parts = {"mass": G.PM_MASS, "count": G.PM_COUNT, "cf": G.PM_CF}
    return rounded(merge_on_time({n: G.sub_table(s, rule) for n, rule in parts.items()}, keys=("device",), how="left"))


# Slanted strips, one a nation: their borders cross the cells of the grid.
_STRIP = "(-180 + 14.4::DOUBLE * (n_nationkey{0}) + 4) + (latitude - -90) * ((-180 + 14.4::DOUBLE * (n_nationkey{0}) - 4) - (-180 + 14.4::DOUBLE * (n_nationkey{0}) + 4)) / 180"


@query("jn9_zone_polygons", sql=with_(DEVICES, AEV) + f"""
SELECT device_id, n_name AS zone, count(*) AS rows
FROM arec LEFT JOIN nation ON latitude IS NOT NULL AND longitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0)
  AND longitude >= {_STRIP.format('')} AND longitude < {_STRIP.format(' + 1')}
GROUP BY 1, 2
""")
def jn9_zone_polygons(spark, sf_dir):
    """Air records per device and zone, the zones being polygons: a strip of the map for each nation, with slanted borders."""
    from senslake.operators import air, zones
    from senslake.sources import payloads
    from senslake.sources.tables import read_table
    n = read_table(spark, sf_dir, "nation")
    edge = lambda i, shift: F.lit(-180.0) + F.lit(14.4) * (F.col("n_nationkey") + i) + F.lit(float(shift))
    corners = [F.struct(edge(i, s).alias("lon"), F.lit(lat).alias("lat")) for i, s, lat in ((0, 4, -90.0), (1, 4, -90.0), (1, -4, 90.0), (0, -4, 90.0))]
    cells = zones.zone_cells(n.select(F.col("n_name").alias("zone"), F.array(*corners).alias("ring")))
    r = air.project(payloads.air_records(model.air_raw(spark, sf_dir))).select("device_id", "latitude", "longitude")
    return zones.attach_zone(r, cells).groupBy("device_id", "zone").agg(F.count("*").alias("rows"))


@query("prj38_documented_columns", sql=with_(DEVICES, """
aev AS (
  SELECT e.user_id AS device_id, e.ts, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM events e JOIN devices d ON e.user_id = d.device_id WHERE d.device_type = 'air')""") + """
SELECT device_id, ts AS recorded_at, round(CASE WHEN k % 6 <> 0 THEN k / 100.0::DOUBLE END / 1000, 9) AS pm_size_um
FROM aev
""")
def prj38_documented_columns(spark, sf_dir):
    """Documented-only derived column: particle size in micrometres (nm / 1000)."""
    e = model.air_events(spark, sf_dir)
    rec = model.air_record()
    return e.select("device_id", F.col("recorded_at"), F.round(rec["pm_size"] / 1000, 9).alias("pm_size_um"))

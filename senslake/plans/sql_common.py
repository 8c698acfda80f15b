"""DuckDB CTE fragments mirroring ``senslake.plans.model`` for the oracle SQL."""

ANALYSIS_LONG = """
analysis_long AS (
  SELECT event_type AS df, CAST(user_id AS VARCHAR) AS device_id, ts AS datetime,
         'k' AS "column", CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS value
  FROM events
  UNION ALL
  SELECT event_type, CAST(user_id AS VARCHAR), ts, 'value', value FROM events
)"""

READINGS = """
readings AS (
  SELECT event_id, user_id AS device_id, event_type AS data_type, ts AS recorded_at, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

HOURLY_LONG = """
hourly_long AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, date_trunc('hour', ts) AS datetime,
         event_type AS "column", avg(value) AS value, 'hourly' AS df
  FROM events GROUP BY 1, 2, 3
)"""

HOURLY_ROWS = """
hourly_rows AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id,
         min(date_trunc('hour', ts)) AS first_hour, max(date_trunc('hour', ts)) AS last_hour,
         CAST((epoch(max(date_trunc('hour', ts))) - epoch(min(date_trunc('hour', ts)))) / 3600 + 1 AS BIGINT) AS rows
  FROM events GROUP BY 1
)"""

DEVICES = """
devices AS (
  SELECT c_custkey AS device_id,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'wearable' ELSE 'air' END AS device_type,
         n_name AS site,
         CASE r_name WHEN 'AFRICA' THEN 'Africa/Lagos' WHEN 'AMERICA' THEN 'America/New_York'
                     WHEN 'ASIA' THEN 'Asia/Kolkata' WHEN 'EUROPE' THEN 'Europe/Berlin' END AS timezone,
         upper(concat_ws(':', substr(lpad(hex(c_custkey), 12, '0'), 1, 2), substr(lpad(hex(c_custkey), 12, '0'), 3, 2),
                   substr(lpad(hex(c_custkey), 12, '0'), 5, 2), substr(lpad(hex(c_custkey), 12, '0'), 7, 2),
                   substr(lpad(hex(c_custkey), 12, '0'), 9, 2), substr(lpad(hex(c_custkey), 12, '0'), 11, 2))) AS mac
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""

ASSIGNMENTS = """
assignments AS (
  SELECT c_custkey * 10 + 1 AS assignment_id, c_custkey AS device_id, 'P' || c_custkey AS participant_id,
         DATE '2024-01-01' AS assigned_from,
         CAST(DATE '2024-01-01' + CAST(5 + c_custkey % 10 AS INTEGER) AS DATE) AS assigned_until
  FROM customer
  UNION ALL
  SELECT c_custkey * 10 + 2, c_custkey, 'P' || (c_custkey + 1),
         CAST(DATE '2024-01-01' + CAST(5 + c_custkey % 10 + c_custkey % 3 AS INTEGER) AS DATE), CAST(NULL AS DATE)
  FROM customer
  UNION ALL
  SELECT c_custkey * 10 + 3, c_custkey, 'Q' || c_custkey,
         CAST(DATE '2024-01-01' + CAST(5 + c_custkey % 10 - 2 AS INTEGER) AS DATE),
         CAST(DATE '2024-01-01' + CAST(5 + c_custkey % 10 + 1 AS INTEGER) AS DATE)
  FROM customer WHERE c_custkey % 50 = 0
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"

FILE_CHUNKS = """
file_rows AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, ts AS datetime, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
file_chunks AS (
  SELECT CAST(device_id || '_01-Jan-2024_20-Jan-2024' AS VARCHAR) AS file_key, device_id, datetime, event_type,
         value, k, CAST(NULL AS VARCHAR) AS firmware
  FROM file_rows WHERE day(datetime) <= 20
  UNION ALL
  SELECT device_id || '_15-Jan-2024_30-Jan-2024', device_id, datetime, event_type,
         CASE WHEN k % 7 = 0 THEN value + 1 ELSE value END, k, '2.1'
  FROM file_rows WHERE day(datetime) >= 15
  UNION ALL
  SELECT device_id || '_30-Jan-2024', device_id, datetime, event_type,
         CASE WHEN k % 7 = 0 THEN value + 1 ELSE value END, k, '2.1'
  FROM file_rows WHERE day(datetime) = 30 AND CAST(device_id AS BIGINT) % 10 = 0
  UNION ALL
  SELECT device_id || '_31-Foo-2024_01-Jan-2024', device_id, datetime, event_type, value, k, NULL
  FROM file_rows WHERE day(datetime) = 1 AND CAST(device_id AS BIGINT) % 25 = 0
)"""

FILE_KEYS = """
file_keys AS (
  SELECT file_key,
         regexp_extract(file_key, '^([A-Za-z0-9]+)_(.+)$', 1) AS device_id,
         list_filter(list_transform(string_split(regexp_extract(file_key, '^([A-Za-z0-9]+)_(.+)$', 2), '_'),
                                    lambda x: try_strptime(trim(x), '%d-%b-%Y')), lambda x: x IS NOT NULL) AS dates
  FROM (SELECT DISTINCT file_key FROM file_chunks)
),
file_index AS (
  SELECT file_key, device_id, CAST(dates[1] AS TIMESTAMP) AS start_date, CAST(dates[-1] AS TIMESTAMP) AS end_date
  FROM file_keys
)"""

# Wearable events and the rows their payloads must normalise to.
WEV = """
wev AS (
  SELECT e.event_id, e.user_id AS device_id, e.event_type, e.ts, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, d.timezone,
         CASE WHEN d.timezone IS NOT NULL
              THEN (CAST(CAST(e.ts AS DATE) AS TIMESTAMP) AT TIME ZONE d.timezone) AT TIME ZONE 'UTC' END AS d_start,
         CASE WHEN d.timezone IS NOT NULL
              THEN (CAST(CAST(e.ts AS DATE) + 1 AS TIMESTAMP) AT TIME ZONE d.timezone) AT TIME ZONE 'UTC' END AS d_end,
         CASE WHEN d.timezone IS NULL THEN 'daily grain: device has no timezone' END AS d_err
  FROM events e JOIN devices d ON e.user_id = d.device_id
  WHERE d.device_type = 'wearable'
)"""

W_POINTS = """
w_points AS (
  SELECT event_id AS ingest_id, device_id, t.data_type, 0 AS point_pos
  FROM wev, (VALUES ('view', 'steps'), ('view', 'active-minutes'), ('click', 'heart-rate'),
                    ('click', 'respiratory-rate-sleep-summary'), ('purchase', 'active-zone-minutes'),
                    ('purchase', 'exercise'), ('purchase', 'calories-in-heart-rate-zone'),
                    ('signup', 'daily-oxygen-saturation'), ('signup', 'daily-heart-rate-variability'),
                    ('signup', 'daily-heart-rate-zones'), ('error', 'activity-level'), ('error', 'sleep'),
                    ('error', 'sedentary-period'), ('error', 'weight'), ('error', 'mystery-metric')) t(et, data_type)
  WHERE wev.event_type = t.et
    AND NOT (t.data_type = 'weight' AND k % 2 <> 0)
    AND NOT (t.data_type = 'mystery-metric' AND k % 3 <> 0)
)"""

_IV = "ts AS recorded_at, ts + INTERVAL 1 MINUTE AS ended_at"
_NOERR = "CAST(NULL AS VARCHAR) AS error"
_ZONE = "CASE k % 4 WHEN 0 THEN 'FAT_BURN' WHEN 1 THEN 'CARDIO' WHEN 2 THEN 'PEAK' END"
_LEVEL = "CASE k % 4 WHEN 0 THEN 'SEDENTARY' WHEN 1 THEN 'LIGHT' WHEN 2 THEN 'MODERATE' ELSE 'VERY' END"
_OXY_SPAN = ("CASE WHEN event_id % 997 <> 0 THEN d_start END AS recorded_at, "
             "CASE WHEN event_id % 997 <> 0 THEN d_end END AS ended_at, "
             "CASE WHEN event_id % 997 = 0 THEN 'daily grain: no usable date at $.dailyOxygenSaturation.date' "
             "ELSE d_err END AS error")
_DAY_SPAN = "d_start AS recorded_at, d_end AS ended_at, d_err AS error"

W_ITEMS = f"""
w_items AS (
  SELECT 'scalar' AS kind, device_id, 'steps' AS data_type, 'interval' AS grain, {_IV},
         'steps' AS metric, CAST(NULL AS VARCHAR) AS tag, CAST(k AS DOUBLE) AS value_numeric,
         event_id AS ingest_id, {_NOERR} FROM wev WHERE event_type = 'view'
  UNION ALL
  SELECT 'list_fanout', device_id, 'active-minutes', 'interval', {_IV}, 'active_minutes', t.tag,
         CASE t.tag WHEN 'LIGHT' THEN CAST(k AS DOUBLE) ELSE value END, event_id, {_NOERR}
  FROM wev, (VALUES ('LIGHT'), ('MODERATE')) t(tag) WHERE event_type = 'view' AND k % 5 <> 0
  UNION ALL
  SELECT 'scalar', device_id, 'heart-rate', 'sample', ts, CAST(NULL AS TIMESTAMP), 'heart_rate_bpm', NULL,
         value, event_id, {_NOERR} FROM wev WHERE event_type = 'click'
  UNION ALL
  SELECT 'respiratory', device_id, 'respiratory-rate-sleep-summary', 'sample', ts, CAST(NULL AS TIMESTAMP),
         t.metric, t.tag,
         CASE t.metric WHEN 'respiratory_rate_stddev' THEN k / 10.0::DOUBLE
                       WHEN 'respiratory_rate_snr' THEN NULL
                       ELSE CASE t.tag WHEN 'deep' THEN value ELSE value + 1 END END,
         event_id, {_NOERR}
  FROM wev, (VALUES ('respiratory_rate_brpm', 'deep'), ('respiratory_rate_stddev', 'deep'),
                    ('respiratory_rate_snr', 'deep'), ('respiratory_rate_brpm', 'full')) t(metric, tag)
  WHERE event_type = 'click'
  UNION ALL
  SELECT 'tagged_scalar', device_id, 'active-zone-minutes', 'interval', {_IV}, 'active_zone_minutes',
         {_ZONE}, CAST(k AS DOUBLE), event_id, {_NOERR} FROM wev WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'list_fanout', device_id, 'calories-in-heart-rate-zone', 'daily', {_DAY_SPAN.replace(', d_err AS error', '')},
         'calories_in_hr_zone_kcal', t.tag, CASE t.tag WHEN 'PEAK' THEN value ELSE CAST(k AS DOUBLE) END,
         event_id, d_err
  FROM wev, (VALUES ('PEAK'), ('CARDIO')) t(tag) WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'tag_map', device_id, 'daily-oxygen-saturation', 'daily',
         CASE WHEN event_id % 997 <> 0 THEN d_start END, CASE WHEN event_id % 997 <> 0 THEN d_end END,
         'oxygen_saturation_pct', t.tag,
         CASE t.tag WHEN 'avg' THEN value WHEN 'lower' THEN value - 1 WHEN 'upper' THEN value + 1
                    ELSE k / 10.0::DOUBLE END,
         event_id,
         CASE WHEN event_id % 997 = 0 THEN 'daily grain: no usable date at $.dailyOxygenSaturation.date'
              ELSE d_err END
  FROM wev, (VALUES ('avg'), ('lower'), ('upper'), ('stddev')) t(tag)
  WHERE event_type = 'signup' AND NOT (t.tag = 'upper' AND k % 2 = 0)
  UNION ALL
  SELECT 'field_map', device_id, 'daily-heart-rate-variability', 'daily', d_start, d_end, t.metric, NULL,
         CASE t.metric WHEN 'hrv_avg_nightly_ms' THEN value WHEN 'hrv_non_rem_hr_bpm' THEN CAST(k AS DOUBLE)
                       ELSE k / 7.0::DOUBLE END,
         event_id, d_err
  FROM wev, (VALUES ('hrv_avg_nightly_ms'), ('hrv_non_rem_hr_bpm'), ('hrv_entropy')) t(metric)
  WHERE event_type = 'signup' AND NOT (t.metric = 'hrv_entropy' AND k % 3 = 0)
  UNION ALL
  SELECT 'hr_zones', device_id, 'daily-heart-rate-zones', 'daily', d_start, d_end, 'hr_zone_bpm', t.tag,
         CASE t.tag WHEN 'LIGHT_min' THEN 90.0 WHEN 'LIGHT_max' THEN CAST(90 + k AS DOUBLE)
                    WHEN 'None_min' THEN CAST(k AS DOUBLE) END,
         event_id, d_err
  FROM wev, (VALUES ('LIGHT_min'), ('LIGHT_max'), ('None_min'), ('None_max')) t(tag)
  WHERE event_type = 'signup'
  UNION ALL
  SELECT 'categorical', device_id, 'activity-level', 'interval', {_IV}, 'activity_level', {_LEVEL}, NULL,
         event_id, {_NOERR} FROM wev WHERE event_type = 'error'
)"""

W_READINGS = """
w_readings AS (
  SELECT kind, device_id, data_type, grain, recorded_at, ended_at, metric, tag, value_numeric,
         CASE WHEN value_numeric IS NULL AND tag IS NOT NULL THEN tag END AS value_text, ingest_id, error
  FROM w_items
)"""

READINGS_COLS = ("device_id, data_type, grain, recorded_at, ended_at, metric, tag, "
                 "round(value_numeric, 6) AS value_numeric, value_text, ingest_id, error")

W_RAW = """
w_raw AS (
  SELECT event_id AS ingest_id, 'wearable' AS device_type, device_id,
         CASE WHEN k % 17 = 0 THEN 'cron' WHEN k % 3 = 0 THEN 'api_auto' WHEN k % 3 = 1 THEN 'api_manual'
              ELSE 'test_script' END AS ingest_method,
         ts + INTERVAL 1 HOUR AS pulled_at
  FROM wev
)"""

W_FAILED = """
w_failed AS (
  SELECT device_id, min(error) AS error_message FROM w_readings WHERE error IS NOT NULL GROUP BY 1
)"""

AEV = """
aev AS (
  SELECT e.event_id, e.user_id AS device_id, e.ts, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, d.timezone, d.mac
  FROM events e JOIN devices d ON e.user_id = d.device_id WHERE d.device_type = 'air'
),
arec AS (
  SELECT a.*, c.copy, a.event_id // 64 AS batch,
         min(a.event_id) OVER (PARTITION BY a.device_id, a.event_id // 64) AS ingest_id,
         CAST(row_number() OVER (PARTITION BY a.device_id, a.event_id // 64 ORDER BY a.ts, a.event_id, c.copy) - 1
              AS INTEGER) AS point_pos,
         max(a.ts) OVER (PARTITION BY a.device_id, a.event_id // 64) + INTERVAL 1 HOUR AS pulled_at,
         CASE WHEN k % 3 = 0 THEN 'Z' WHEN k % 3 = 1 THEN '+05:30' ELSE 'local' END AS date_form,
         CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 IN (1, 2) THEN 0.0::DOUBLE
              ELSE round((device_id * 1 % 170) - 85.0 + k / 100.0::DOUBLE, 4) END AS latitude,
         CASE WHEN k % 10 = 1 THEN 0.0::DOUBLE
              ELSE round((device_id * 7 % 350) - 175.0 + k / 100.0::DOUBLE, 4) END AS longitude,
         k AS aqs, value / 3 AS pm1, value AS pm25, value * 1.5 AS pm10,
         CASE WHEN k % 6 <> 0 THEN k / 100.0::DOUBLE END AS pm_size,
         CASE WHEN k % 4 <> 0 THEN k * 10 END AS pm05_num, k * 5 AS pm1_num, k * 2 AS pm10_num,
         k * 3 AS pm25_num, value / 10 AS temperature, CAST(k AS DOUBLE) AS humidity,
         1000.0 + k / 10.0::DOUBLE AS pressure, k / 1000.0::DOUBLE AS voc, k + 1 AS voc_index,
         k + 2 AS nox_index, 400 + k AS co2, 100 - k AS battery, k % 3 = 0 AS charging,
         k % 3 = 1 AS recently_charged, k % 2 = 0 AS motion, 10 + k AS altitude, k % 7 AS position_error,
         CASE WHEN k % 5 <> 0 THEN k % 12 END AS satellites_fixed, k % 12 + 3 AS satellites_in_view
  FROM aev a, (VALUES (0), (1)) c(copy) WHERE c.copy = 0 OR a.k % 13 = 0
)"""

# Air pulls as they arrive: those whose id divides by 41 are cut short and fail their device.
A_RAW = """
a_raw AS (
  SELECT DISTINCT ingest_id, 'air' AS device_type, device_id, 'api_auto' AS ingest_method, pulled_at, ingest_id % 41 = 0 AS broken
  FROM arec
)"""

AIR_SENSORS = ("aqs, round(pm1, 6) AS pm1, round(pm25, 6) AS pm25, round(pm10, 6) AS pm10, "
               "round(pm_size, 6) AS pm_size, pm05_num, pm1_num, pm10_num, pm25_num, "
               "round(temperature, 6) AS temperature, round(humidity, 6) AS humidity, "
               "round(pressure, 6) AS pressure, round(voc, 6) AS voc, voc_index, nox_index, co2, battery, "
               "charging, recently_charged, motion, altitude, position_error, satellites_fixed, "
               "satellites_in_view")

CSV_ROWS = """
csv_src AS (
  SELECT a.*, v.ver, a.event_id // 256 AS batch,
         CASE WHEN v.ver = '_v2' AND a.k % 31 = 0 THEN a.value + 1 ELSE a.value END AS pm25_v
  FROM aev a, (VALUES (''), ('_v2')) v(ver)
  WHERE v.ver = '' OR a.k % 29 = 0 OR a.k % 31 = 0
),
csv_named AS (
  SELECT *,
         CASE WHEN device_id % 9 = 0
              THEN 'export_' || CAST(device_id AS VARCHAR) || '_' || CAST(batch AS VARCHAR) || ver || '.csv'
              ELSE replace(mac, ':', '') || '_'
                   || strftime(min(ts) OVER (PARTITION BY device_id, batch, ver), '%d-%b-%Y') || '_'
                   || strftime(max(ts) OVER (PARTITION BY device_id, batch, ver), '%d-%b-%Y') || '_p' || CAST(batch AS VARCHAR)
                   || ver || '.csv'
         END AS file_name
  FROM csv_src
),
csv_recs AS (
  SELECT file_name, device_id, ver, date_trunc('second', ts) AS recorded_at,
         k AS aqs, value / 3 AS pm1, pm25_v AS pm25, CASE WHEN k % 8 <> 0 THEN value * 1.5 END AS pm10,
         CASE WHEN k % 9 <> 0 THEN value / 10 END AS temperature,
         CASE WHEN k % 11 <> 0 THEN CAST(k AS DOUBLE) END AS humidity,
         1000.0 + k / 10.0::DOUBLE AS pressure, k / 1000.0::DOUBLE AS voc, k + 1 AS voc_index, k + 2 AS nox_index,
         400 + k AS co2, 100 - k AS battery, 10 + k AS altitude, k % 7 AS position_error,
         CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 IN (1, 2) THEN 0.0::DOUBLE
              ELSE round((device_id * 1 % 170) - 85.0 + k / 100.0::DOUBLE, 4) END AS latitude,
         CASE WHEN k % 10 = 1 THEN 0.0::DOUBLE
              ELSE round((device_id * 7 % 350) - 175.0 + k / 100.0::DOUBLE, 4) END AS longitude,
         k % 19 <> 0 AND k % 3 = 0 AS charging, k % 19 <> 0 AND k % 3 = 1 AS recently_charged,
         k % 19 <> 0 AND k % 2 = 0 AS motion
  FROM csv_named
)"""

CSV_FIELDS = ("aqs, round(pm1, 6) AS pm1, round(pm25, 6) AS pm25, round(pm10, 6) AS pm10, "
              "round(temperature, 6) AS temperature, round(humidity, 6) AS humidity, "
              "round(pressure, 6) AS pressure, voc_index, round(voc, 6) AS voc, nox_index, co2, "
              "latitude, longitude, altitude, position_error, battery")

LEGACY = """
leg AS (
  SELECT CAST(device_id AS VARCHAR) AS device, ts AS datetime, k % 50 <> 0 AS ok, device_id, k, value,
         CASE WHEN k % 50 = 0 THEN NULL WHEN k % 10 = 0 THEN NULL WHEN k % 10 IN (1, 2) THEN 0.0::DOUBLE
              ELSE round((device_id * 1 % 170) - 85.0 + k / 100.0::DOUBLE, 4) END AS latitude,
         CASE WHEN k % 50 = 0 THEN NULL WHEN k % 10 = 1 THEN 0.0::DOUBLE
              ELSE round((device_id * 7 % 350) - 175.0 + k / 100.0::DOUBLE, 4) END AS longitude
  FROM aev
),
cells AS (
  SELECT cell_lat, cell_lon, arg_min(tz, (-n, tz)) AS timezone FROM (
    SELECT floor(lat / 1.0) AS cell_lat, floor(lon / 1.0) AS cell_lon, timezone AS tz, count(*) AS n
    FROM (SELECT timezone,
                 CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 IN (1, 2) THEN 0.0::DOUBLE
                      ELSE round((device_id * 1 % 170) - 85.0 + k / 100.0::DOUBLE, 4) END AS lat,
                 CASE WHEN k % 10 = 1 THEN 0.0::DOUBLE
                      ELSE round((device_id * 7 % 350) - 175.0 + k / 100.0::DOUBLE, 4) END AS lon
          FROM aev)
    WHERE timezone IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat = 0 AND lon = 0)
    GROUP BY 1, 2, 3) GROUP BY 1, 2
),
leg_tz AS (
  SELECT l.*, c.timezone FROM leg l LEFT JOIN cells c
    ON l.latitude IS NOT NULL AND l.longitude IS NOT NULL AND NOT (l.latitude = 0 AND l.longitude = 0)
   AND floor(l.latitude / 1.0) = c.cell_lat AND floor(l.longitude / 1.0) = c.cell_lon
)"""

"""Registered queries: wearable payload scan and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from senslake.operators import normalize as N
from senslake.plans import model
from senslake.plans.registry import query, rounded
from senslake.plans.sql_common import (DEVICES, READINGS_COLS, W_ITEMS, W_POINTS, W_READINGS, WEV,
                                       with_)
from senslake.registry import WEARABLE_REGISTRY
from senslake.sources import payloads

_W = with_(DEVICES, WEV, W_ITEMS, W_READINGS)
_OUT = ["device_id", "data_type", "grain", "recorded_at", "ended_at", "metric", "tag",
        "value_numeric", "value_text", "ingest_id", "error"]


def points(spark, sf_dir):
    return payloads.wearable_points(model.wearable_raw(spark, sf_dir))


def readings(spark, sf_dir):
    return N.readings(points(spark, sf_dir))


def _kind(k):
    return [t for t, r in WEARABLE_REGISTRY.items() if r["kind"] == k]


def _readings_of(types):
    def run(spark, sf_dir):
        return rounded(readings(spark, sf_dir).where(F.col("data_type").isin(types)).select(*_OUT))
    return run


@query("src1_wearable_points", sql=with_(DEVICES, WEV, W_POINTS) + """
SELECT ingest_id, device_id, data_type, point_pos FROM w_points
""")
def src1_wearable_points(spark, sf_dir):
    """Payload -> one row per data point (dataPoints, else rollupDataPoints)."""
    return points(spark, sf_dir).select(
        "ingest_id", "device_id", "data_type", F.col("point_pos").cast("int").alias("point_pos"))


@query("prj15_route_counts", sql=with_(DEVICES, WEV, W_POINTS) + """
SELECT CASE WHEN data_type IN ('steps', 'heart-rate', 'active-minutes', 'active-zone-minutes',
                               'calories-in-heart-rate-zone', 'daily-oxygen-saturation',
                               'daily-heart-rate-variability', 'activity-level') THEN 'registry'
            WHEN data_type IN ('sleep', 'exercise', 'daily-heart-rate-zones',
                               'respiratory-rate-sleep-summary') THEN 'bespoke'
            WHEN data_type = 'sedentary-period' THEN 'dropped'
            WHEN data_type = 'weight' THEN 'unmapped' ELSE 'unrecognised' END AS route,
       data_type, count(*) AS points
FROM w_points GROUP BY 1, 2
""")
def prj15_route_counts(spark, sf_dir):
    """Points per route: registry / bespoke / dropped / unmapped / unrecognised."""
    return N.route_counts(points(spark, sf_dir))


@query("flt3_dropped_unmapped", sql=with_(DEVICES, WEV, W_POINTS) + """
SELECT data_type, count(*) AS points FROM w_points
WHERE data_type NOT IN ('steps', 'heart-rate', 'active-minutes', 'active-zone-minutes',
                        'calories-in-heart-rate-zone', 'daily-oxygen-saturation',
                        'daily-heart-rate-variability', 'activity-level', 'sleep', 'exercise',
                        'daily-heart-rate-zones', 'respiratory-rate-sleep-summary')
GROUP BY 1
""")
def flt3_dropped_unmapped(spark, sf_dir):
    """Points not loaded: dropped, unmapped and unrecognised types."""
    p = points(spark, sf_dir)
    return (p.where(N.route(F.col("data_type")).isin("dropped", "unmapped", "unrecognised"))
            .groupBy("data_type").agg(F.count("*").alias("points")))


for _key, _kinds, _doc in [
    ("prj3_scalar", ["scalar"], "scalar: one field, one row"),
    ("prj4_categorical", ["categorical"], "categorical: state in tag, value null"),
    ("prj5_tagged_scalar", ["tagged_scalar"], "tagged scalar: value plus sibling tag"),
    ("prj6_list_fanout", ["list_fanout"], "list fan-out: one row per list item"),
    ("prj7_tag_map", ["tag_map"], "tag map: sibling fields, same metric, nulls skipped"),
    ("prj8_field_map", ["field_map"], "field map: sibling fields, distinct metrics, nulls skipped"),
]:
    _types = [t for k in _kinds for t in _kind(k)]
    _sql = _W + f"SELECT {READINGS_COLS} FROM w_readings WHERE kind IN ({', '.join(repr(k) for k in _kinds)})"
    _fn = _readings_of(_types)
    _fn.__doc__ = _doc
    query(_key, sql=_sql)(_fn)


_hr = _readings_of(["daily-heart-rate-zones"])
_hr.__doc__ = "HR-zone calibration: <ZONE>_min / <ZONE>_max rows, null bounds kept, untyped zone 'None'."
query("prj9_hr_zones", sql=_W + f"SELECT {READINGS_COLS} FROM w_readings WHERE kind = 'hr_zones'")(_hr)
_resp = _readings_of(["respiratory-rate-sleep-summary"])
_resp.__doc__ = "Respiratory sleep summary: 4 stages x 3 metrics, tag = stage, only absent keys skipped."
query("prj10_respiratory", sql=_W + f"SELECT {READINGS_COLS} FROM w_readings WHERE kind = 'respiratory'")(_resp)


@query("prj16_value_text", sql=_W + """
SELECT data_type, value_text, count(*) AS rows FROM w_readings WHERE value_text IS NOT NULL GROUP BY 1, 2
""")
def prj16_value_text(spark, sf_dir):
    """value_text is the tag whenever the value is null and the tag is not."""
    return (readings(spark, sf_dir).where(F.col("value_text").isNotNull())
            .groupBy("data_type", "value_text").agg(F.count("*").alias("rows")))


@query("prj17_grain_span", sql=_W + """
SELECT DISTINCT device_id, data_type, grain, recorded_at, ended_at, error FROM w_readings
""")
def prj17_grain_span(spark, sf_dir):
    """(grain, start, end, error) per point: sample / interval / daily local
    midnight to next local midnight in UTC (DST-aware); missing date or
    timezone -> error."""
    return readings(spark, sf_dir).select("device_id", "data_type", "grain", "recorded_at",
                                          "ended_at", "error").distinct()


@query("scl4_local_midnight_utc", sql=with_(DEVICES, WEV) + """
SELECT DISTINCT timezone, CAST(ts AS DATE) AS day, d_start AS day_start_utc, d_end AS day_end_utc
FROM wev WHERE timezone IS NOT NULL
""")
def scl4_local_midnight_utc(spark, sf_dir):
    """Local midnight and next local midnight, in UTC, per (timezone, day)."""
    from senslake.functions.time import local_midnight_utc
    e = model.wearable_events(spark, sf_dir).where(F.col("timezone").isNotNull())
    d = F.to_date("recorded_at")
    s, en = local_midnight_utc(d, F.col("timezone"))
    return e.select("timezone", d.alias("day"), s.alias("day_start_utc"), en.alias("day_end_utc")).distinct()


@query("scl1_iso_to_utc", sql=with_(DEVICES, WEV) + """
SELECT event_id AS ingest_id, ts AS recorded_at FROM wev WHERE event_type = 'click'
""")
def scl1_iso_to_utc(spark, sf_dir):
    """ISO strings with 'Z' or '+05:30' offsets -> the same UTC instant."""
    r = readings(spark, sf_dir).where(F.col("data_type") == "heart-rate")
    return r.select("ingest_id", "recorded_at")


@query("prj2_path_lookup", sql=with_(DEVICES, WEV, W_POINTS) + """
SELECT p.ingest_id, p.data_type,
       CASE WHEN p.data_type IN ('steps', 'active-minutes', 'active-zone-minutes', 'exercise', 'activity-level',
                                 'sleep', 'sedentary-period')
            THEN strftime(w.ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS start_text
FROM w_points p JOIN wev w ON p.ingest_id = w.event_id
""")
def prj2_path_lookup(spark, sf_dir):
    """Dotted-path lookup '<type>.interval.startTime' for every point; null
    where any level is missing."""
    from senslake.registry import camel
    p = points(spark, sf_dir)
    expr = None
    for t in _ALL_TYPES:
        c = N.vget(f"$.{camel(t)}.interval.startTime")
        expr = F.when(F.col("data_type") == t, c) if expr is None else expr.when(F.col("data_type") == t, c)
    return p.select("ingest_id", "data_type", expr.alias("start_text"))


_ALL_TYPES = ["steps", "active-minutes", "heart-rate", "respiratory-rate-sleep-summary", "active-zone-minutes",
              "exercise", "calories-in-heart-rate-zone", "daily-oxygen-saturation",
              "daily-heart-rate-variability", "daily-heart-rate-zones", "activity-level", "sleep",
              "sedentary-period", "weight", "mystery-metric"]


_SESS = with_(DEVICES, WEV)


@query("prj11_sleep_sessions", sql=_SESS + """
SELECT device_id, ts AS started_at, ts + INTERVAL 480 MINUTE AS ended_at, 'STAGES' AS sleep_type,
       k % 5 = 0 AS is_nap, 480 AS minutes_in_sleep_period, k % 10 AS minutes_after_wakeup,
       k % 20 AS minutes_to_fall_asleep, k + 400 AS minutes_asleep, 80 - k % 80 AS minutes_awake,
       event_id AS ingest_id
FROM wev WHERE event_type = 'error'
""")
def prj11_sleep_sessions(spark, sf_dir):
    """One sleep session row per sleep point: interval, type, nap flag, minute counters."""
    return N.sleep_sessions(points(spark, sf_dir)).select(
        "device_id", "started_at", "ended_at", "sleep_type", "is_nap", "minutes_in_sleep_period",
        "minutes_after_wakeup", "minutes_to_fall_asleep", "minutes_asleep", "minutes_awake", "ingest_id")


@query("prj12_sleep_stages", sql=_SESS + """
SELECT device_id, ts AS session_started_at, ts + t.s * INTERVAL 1 MINUTE AS started_at,
       ts + t.e * INTERVAL 1 MINUTE AS ended_at, t.typ AS stage_type, event_id AS ingest_id
FROM wev, (VALUES (0, 60, 'LIGHT'), (60, 180, 'DEEP')) t(s, e, typ) WHERE event_type = 'error'
""")
def prj12_sleep_stages(spark, sf_dir):
    """Sleep stage rows carrying their session's start time."""
    return N.sleep_stages(points(spark, sf_dir)).select(
        "device_id", "session_started_at", "started_at", "ended_at", "stage_type", "ingest_id")


@query("prj13_exercise", sql=_SESS + """
SELECT device_id, ts AS started_at, ts + INTERVAL 45 MINUTE AS ended_at, 'WALKING' AS exercise_type,
       'Walk' AS display_name, round(value, 6) AS calories_kcal, CAST(k * 1000 AS DOUBLE) AS distance_mm,
       k * 10 AS steps, 0.8::DOUBLE AS avg_pace_sec_per_meter, k + 60 AS avg_heart_rate_bpm,
       k * 60 AS light_time_sec, 60 AS moderate_time_sec, CAST(NULL AS INTEGER) AS vigorous_time_sec,
       CAST(NULL AS INTEGER) AS peak_time_sec, event_id AS ingest_id
FROM wev WHERE event_type = 'purchase'
""")
def prj13_exercise(spark, sf_dir):
    """Exercise sessions with the metrics summary flattened and zone durations in seconds."""
    return rounded(N.exercise_sessions(points(spark, sf_dir)).drop("pulled_at", "point_pos", "error"))


@query("scl5_duration_seconds", sql=_SESS + """
SELECT event_id AS ingest_id, k * 60 AS light_time_sec, 60 AS moderate_time_sec,
       CAST(NULL AS INTEGER) AS vigorous_time_sec
FROM wev WHERE event_type = 'purchase'
""")
def scl5_duration_seconds(spark, sf_dir):
    """'1860s' duration strings -> integer seconds; absent -> null."""
    return N.exercise_sessions(points(spark, sf_dir)).select(
        "ingest_id", "light_time_sec", "moderate_time_sec", "vigorous_time_sec")


_PROFILE_SQL = _SESS + """
SELECT device_id, ts + INTERVAL 1 HOUR AS recorded_at, 20 + k % 50 AS age,
       CASE WHEN k % 4 <> 0 THEN make_date(2020 + k % 4, 1 + k % 12, 1 + k % 28) END AS membership_start_date,
       700 + k AS walking_stride_mm, 900 + k AS running_stride_mm
FROM wev WHERE event_type = 'signup'
"""


@query("prj14_profile", sql=_PROFILE_SQL)
def prj14_profile(spark, sf_dir):
    """Profile snapshot per pull, recorded_at = pull time; membership date
    only when year, month and day are all present."""
    return N.profile(payloads.wearable_profile(model.wearable_raw(spark, sf_dir)))


@query("scl6_civil_date", sql=_SESS + """
SELECT event_id AS ingest_id,
       CASE WHEN k % 4 <> 0 THEN make_date(2020 + k % 4, 1 + k % 12, 1 + k % 28) END AS membership_start_date
FROM wev WHERE event_type = 'signup'
""")
def scl6_civil_date(spark, sf_dir):
    """{year, month, day} objects -> DATE; null when a part is missing."""
    from senslake.functions.time import civil_date
    s = payloads.wearable_profile(model.wearable_raw(spark, sf_dir))
    d = civil_date(N.vget("$.membershipStartDate.year", "int", "section"),
                   N.vget("$.membershipStartDate.month", "int", "section"),
                   N.vget("$.membershipStartDate.day", "int", "section"))
    return s.select("ingest_id", d.alias("membership_start_date"))


@query("jn6_device_timezone", sql=_W + """
SELECT d.timezone, count(*) AS readings, count(r.recorded_at) AS with_time
FROM w_readings r JOIN devices d USING (device_id) GROUP BY 1
""")
def jn6_device_timezone(spark, sf_dir):
    """Readings per device timezone (the lookup that places daily grain)."""
    r = readings(spark, sf_dir)
    dev = model.devices(spark, sf_dir).select("device_id", "timezone")
    from senslake.operators.joins import maybe_broadcast
    return (r.join(maybe_broadcast(dev), "device_id")
            .groupBy("timezone").agg(F.count("*").alias("readings"),
                                     F.count("recorded_at").alias("with_time")))

"""Registered queries: study registries, assignments, pull planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from senslake.functions.time import open_until, pull_range
from senslake.operators import study
from senslake.operators.joins import interval_join, maybe_broadcast
from senslake.plans import model
from senslake.plans.registry import query
from senslake.plans.sql_common import ASSIGNMENTS, DEVICES, READINGS, with_

_START = ("CASE WHEN c_custkey % 4 <> 0 THEN CAST(DATE '2024-01-01' + CAST(c_custkey % 7 AS INTEGER) AS DATE) END")


@query("src6_device_registry", sql=with_(DEVICES) + f"""
SELECT CASE WHEN device_type = 'wearable' THEN 'wearable_devices' ELSE 'air_devices' END AS list_key,
       CASE WHEN device_id % 97 <> 0 THEN CAST(device_id AS VARCHAR) END AS device_id, device_type, site,
       timezone, {_START.replace('c_custkey', 'device_id')} AS start_date, mac,
       device_id % 97 <> 0 AS valid
FROM devices
""")
def src6_device_registry(spark, sf_dir):
    """All '*_devices' lists of all registry documents flattened; keys read
    case-insensitively; entries without id/type marked invalid."""
    return study.flatten_devices(model.device_registry_docs(spark, sf_dir))


@query("src7_participant_assignments", sql=with_(ASSIGNMENTS) + """
SELECT participant_id, device_id, assigned_from, assigned_until FROM assignments
""")
def src7_participant_assignments(spark, sf_dir):
    """Participants' nested device_assignments lists flattened to rows."""
    return study.flatten_assignments(model.participant_docs(spark, sf_dir))


@query("win4_assignment_overlap", sql=with_(ASSIGNMENTS) + """
SELECT * FROM (
  SELECT assignment_id, device_id, participant_id, assigned_from, assigned_until,
         max(coalesce(assigned_until, DATE '9999-12-31')) OVER (
           PARTITION BY device_id ORDER BY assigned_from, assignment_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_until
  FROM assignments) WHERE prev_until > assigned_from
""")
def win4_assignment_overlap(spark, sf_dir):
    """Assignments overlapping an earlier one on the same device (rejects)."""
    return study.overlapping_assignments(model.assignments(spark, sf_dir))


@query("scl15_open_range", sql=with_(ASSIGNMENTS) + """
SELECT assignment_id, coalesce(assigned_until, DATE '9999-12-31') AS effective_until FROM assignments
""")
def scl15_open_range(spark, sf_dir):
    """Open-ended assignment ends read as a far-future date."""
    a = model.assignments(spark, sf_dir)
    return a.select("assignment_id", open_until(F.col("assigned_until")).alias("effective_until"))


@query("jn7_reading_participant", sql=with_(READINGS, ASSIGNMENTS) + """
SELECT r.event_id, r.device_id, a.participant_id
FROM readings r LEFT JOIN assignments a
  ON r.device_id = a.device_id AND CAST(r.recorded_at AS DATE) >= a.assigned_from
 AND (a.assigned_until IS NULL OR CAST(r.recorded_at AS DATE) < a.assigned_until)
""")
def jn7_reading_participant(spark, sf_dir):
    """Each reading attributed to the participant(s) holding the device that
    day; readings between assignments get no participant."""
    r = model.readings(spark, sf_dir).select("event_id", "device_id", "recorded_at")
    a = model.assignments(spark, sf_dir)
    return interval_join(r, a, how="left").select("event_id", "device_id", "participant_id")


@query("jn8_registered_vs_delivered", sql=with_(DEVICES) + """
SELECT 'registered_without_data' AS check_name, CAST(device_id AS VARCHAR) AS item FROM devices
WHERE device_id NOT IN (SELECT user_id FROM events)
UNION ALL
SELECT 'delivered_without_registration', CAST(user_id AS VARCHAR) FROM (SELECT DISTINCT user_id FROM events)
WHERE user_id NOT IN (SELECT device_id FROM devices)
UNION ALL
SELECT DISTINCT 'device_type_without_data', device_type FROM devices
WHERE device_type NOT IN (SELECT DISTINCT d.device_type FROM events e JOIN devices d ON e.user_id = d.device_id)
""")
def jn8_registered_vs_delivered(spark, sf_dir):
    """Reconcile the registry with delivered data: registered devices with
    no data, data from unregistered devices, registered types never pulled."""
    dev = model.devices(spark, sf_dir).select("device_id", "device_type")
    got = model.readings(spark, sf_dir).select("device_id").distinct()
    a = dev.join(got, "device_id", "left_anti").select(
        F.lit("registered_without_data").alias("check_name"), F.col("device_id").cast("string").alias("item"))
    b = got.join(dev, "device_id", "left_anti").select(
        F.lit("delivered_without_registration").alias("check_name"), F.col("device_id").cast("string").alias("item"))
    types = dev.select("device_type").distinct()
    pulled = dev.join(got, "device_id").select("device_type").distinct()
    c = types.join(pulled, "device_type", "left_anti").select(
        F.lit("device_type_without_data").alias("check_name"), F.col("device_type").alias("item"))
    return a.unionByName(b).unionByName(c)


_RANGES = with_(READINGS, DEVICES) + """
, ranges AS (
  SELECT r.device_id, d.device_type, min(CAST(r.recorded_at AS DATE)) AS first_day,
         max(CAST(r.recorded_at AS DATE)) AS pull_end
  FROM readings r JOIN devices d USING (device_id) GROUP BY 1, 2)
"""


def _ranges(spark, sf_dir):
    r = model.readings(spark, sf_dir)
    dev = model.devices(spark, sf_dir).select("device_id", "device_type")
    return (r.groupBy("device_id").agg(F.min(F.to_date("recorded_at")).alias("first_day"),
                                        F.max(F.to_date("recorded_at")).alias("pull_end"))
            .join(maybe_broadcast(dev), "device_id"))


@query("scl14_pull_range", sql=_RANGES + """
SELECT device_id, CASE WHEN device_id % 4 = 0 THEN pull_end - 1 ELSE first_day END AS pull_start, pull_end
FROM ranges
""")
def scl14_pull_range(spark, sf_dir):
    """Per device (start, end); a device without a configured start pulls
    only the day before the end (every 4th device here)."""
    r = _ranges(spark, sf_dir)
    start = F.when(F.col("device_id") % 4 != 0, F.col("first_day"))
    s, e = pull_range(start, F.col("pull_end"))
    return r.select("device_id", s.alias("pull_start"), e.alias("pull_end"))


_CHUNKS = _RANGES + """
, types(device_type, data_type, days) AS (VALUES ('air', 'air', 7), ('wearable', 'floors', 90), ('wearable', 'calories-in-heart-rate-zone', 14),
                                                 ('wearable', 'steps', 14))
, chunks AS (
  SELECT device_id, device_type, data_type, CAST(first_day + CAST(i * days AS INTEGER) AS DATE) AS chunk_start,
         CAST(least(first_day + CAST(i * days + days - 1 AS INTEGER), pull_end) AS DATE) AS chunk_end
  FROM ranges JOIN types USING (device_type), range(40) t(i) WHERE first_day + CAST(i * days AS INTEGER) <= pull_end)
"""


def _chunks(spark, sf_dir):
    r = _ranges(spark, sf_dir).withColumnRenamed("first_day", "pull_start")
    return study.plan_pulls(r, {"air": ["air"], "wearable": ["floors", "calories-in-heart-rate-zone", "steps"]})


@query("scl13_date_chunks", sql=_CHUNKS + """
SELECT device_id, device_type, data_type, chunk_start, chunk_end FROM chunks
""")
def scl13_date_chunks(spark, sf_dir):
    """Backfill plan: each device's range per data type, in chunks of at most 7 days (air), 90 or 14 (wearable, by type)."""
    return _chunks(spark, sf_dir).select("device_id", "device_type", "data_type", "chunk_start", "chunk_end")


@query("flt5_half_open_windows", sql=_CHUNKS + """
SELECT c.device_id, c.data_type, c.chunk_start, count(*) AS readings
FROM readings r JOIN chunks c ON r.device_id = c.device_id
 AND r.recorded_at >= CAST(c.chunk_start AS TIMESTAMP) AND r.recorded_at < CAST(c.chunk_end + 1 AS TIMESTAMP)
GROUP BY 1, 2, 3
""")
def flt5_half_open_windows(spark, sf_dir):
    """Readings per pull chunk under the half-open window start <= t < end + 1 day."""
    c = _chunks(spark, sf_dir).select("device_id", "data_type", "chunk_start", F.date_add("chunk_end", 1).alias("chunk_until"))
    r = model.readings(spark, sf_dir).select("device_id", "recorded_at")
    j = interval_join(r, c, start="chunk_start", until="chunk_until")
    return j.groupBy("device_id", "data_type", "chunk_start").agg(F.count("*").alias("readings"))

"""Wearable normalisation on hand-made payloads (FIXTURES.md section 2)."""

import json

from pyspark.sql import functions as F

from senslake.operators import normalize as N
from senslake.sources import payloads


def _raw(spark, payload, tz="America/New_York", device=1):
    return spark.createDataFrame(
        [(7, "wearable", device, "api_auto", None, json.dumps(payload), tz)],
        "ingest_id long, device_type string, device_id long, ingest_method string, "
        "pulled_at timestamp_ntz, payload string, timezone string")


def _readings(spark, payload, **kw):
    pts = payloads.wearable_points(_raw(spark, payload, **kw))
    return N.readings(pts).orderBy("data_type", "metric", "tag").collect()


IV = {"startTime": "2026-07-09T15:31:00Z", "endTime": "2026-07-09T15:32:00Z"}


def test_scalar_string_number_and_interval(spark):
    rows = _readings(spark, {"steps": {"dataPoints": [{"steps": {"interval": IV, "count": "12"}}]}})
    assert len(rows) == 1
    r = rows[0]
    assert (r.metric, r.tag, r.value_numeric, r.grain) == ("steps", None, 12.0, "interval")
    assert str(r.recorded_at) == "2026-07-09 15:31:00" and r.error is None


def test_sample_with_offset_is_utc(spark):
    p = {"heart-rate": {"dataPoints": [{"heartRate": {
        "sampleTime": {"physicalTime": "2026-07-09T21:01:05+05:30"}, "beatsPerMinute": "93"}}]}}
    r = _readings(spark, p)[0]
    assert str(r.recorded_at) == "2026-07-09 15:31:05" and r.ended_at is None


def test_empty_datapoints_fall_through_to_rollup_D19(spark):
    p = {"calories-in-heart-rate-zone": {"dataPoints": [], "rollupDataPoints": [
        {"civilStartTime": {"date": {"year": 2026, "month": 3, "day": 8}},
         "caloriesInHeartRateZone": {"caloriesInHeartRateZones": [{"heartRateZone": "PEAK", "kcal": 1.5}]}}]}}
    r = _readings(spark, p)[0]
    # DST day in New York: 23 hours long.
    assert str(r.recorded_at) == "2026-03-08 05:00:00" and str(r.ended_at) == "2026-03-09 04:00:00"
    assert (r.tag, r.value_numeric) == ("PEAK", 1.5)


def test_tag_map_skips_nulls_and_value_text_D15(spark):
    p = {"daily-oxygen-saturation": {"dataPoints": [{"dailyOxygenSaturation": {
        "date": {"year": 2026, "month": 7, "day": 9}, "averagePercentage": 96.1,
        "lowerBoundPercentage": 94.0, "upperBoundPercentage": None}}]},
         "activity-level": {"dataPoints": [{"activityLevel": {"interval": IV, "activityLevelType": "LIGHT"}}]}}
    rows = _readings(spark, p)
    tags = sorted(r.tag for r in rows if r.data_type == "daily-oxygen-saturation")
    assert tags == ["avg", "lower"]
    act = [r for r in rows if r.data_type == "activity-level"][0]
    assert act.value_numeric is None and act.value_text == "LIGHT" and act.metric == "activity_level"


def test_zone_without_type_D16_and_null_bounds_kept(spark):
    p = {"daily-heart-rate-zones": {"dataPoints": [{"dailyHeartRateZones": {
        "date": {"year": 2026, "month": 7, "day": 9},
        "heartRateZones": [{"minBeatsPerMinute": "90", "maxBeatsPerMinute": None}]}}]}}
    rows = _readings(spark, p)
    assert sorted((r.tag, r.value_numeric) for r in rows) == [("None_max", None), ("None_min", 90.0)]


def test_respiratory_skips_only_absent_keys(spark):
    p = {"respiratory-rate-sleep-summary": {"dataPoints": [{"respiratoryRateSleepSummary": {
        "sampleTime": {"physicalTime": "2026-07-09T15:31:05Z"},
        "deepSleepStats": {"breathsPerMinute": 14.1, "signalToNoise": None}}}]}}
    rows = _readings(spark, p)
    assert sorted((r.metric, r.value_numeric) for r in rows) == [
        ("respiratory_rate_brpm", 14.1), ("respiratory_rate_snr", None)]


def test_daily_without_timezone_or_date_is_an_error_D3(spark):
    p = {"daily-resting-heart-rate": {"dataPoints": [
        {"dailyRestingHeartRate": {"date": {"year": 2026, "month": 7, "day": 9}, "beatsPerMinute": "67"}},
        {"dailyRestingHeartRate": {"beatsPerMinute": "66"}}]}}
    rows = _readings(spark, p, tz=None)
    assert all(r.error for r in rows)
    rows = _readings(spark, p)
    errs = sorted(r.error or "" for r in rows)
    assert errs[0] == "" and "no usable date" in errs[1]


def test_routing_and_dropped_unmapped(spark):
    p = {"steps": None, "sedentary-period": {"dataPoints": [{"x": 1}]},
         "weight": {"dataPoints": [{"x": 1}, {"x": 2}]}, "floors": {"dataPoints": []},
         "brand-new": {"dataPoints": [{"x": 1}]}, "profile": {"age": 3}}
    pts = payloads.wearable_points(_raw(spark, p))
    got = {(r.route, r.data_type): r.points for r in N.route_counts(pts).collect()}
    assert got == {("dropped", "sedentary-period"): 1, ("unmapped", "weight"): 2,
                   ("unrecognised", "brand-new"): 1}


def test_sleep_sessions_stages_exercise_profile(spark):
    p = {"sleep": {"dataPoints": [{"sleep": {"interval": IV, "type": "STAGES", "metadata": {"nap": False},
                                             "summary": {"minutesAsleep": "390"},
                                             "stages": [{"startTime": "2026-07-09T15:31:00Z",
                                                         "endTime": "2026-07-09T15:31:30Z", "type": "LIGHT"}]}}]},
         "exercise": {"dataPoints": [{"exercise": {"interval": IV, "metricsSummary": {
             "steps": "1200", "heartRateZoneDurations": {"lightTime": "1860s"}}}}]},
         "profile": {"age": 34, "membershipStartDate": {"year": 2024, "month": 1}}}
    raw = _raw(spark, p)
    pts = payloads.wearable_points(raw)
    s = N.sleep_sessions(pts).first()
    assert s.minutes_asleep == 390 and s.is_nap is False
    st = N.sleep_stages(pts).first()
    assert st.stage_type == "LIGHT" and st.session_started_at == s.started_at
    ex = N.exercise_sessions(pts).first()
    assert ex.steps == 1200 and ex.light_time_sec == 1860 and ex.peak_time_sec is None
    pr = N.profile(payloads.wearable_profile(raw)).first()
    assert pr.age == 34 and pr.membership_start_date is None

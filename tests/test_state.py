"""Keyed streaming state and event-time coverage against the batch answer."""

import datetime as dt
import uuid

import numpy as np
from pyspark.sql import functions as F

from senslake.sinks import load as L
from senslake.streaming import coverage, state

T0 = dt.datetime(2024, 1, 1)
AIR = "device_id long, recorded_at timestamp_ntz, pm25 double, note string, ingest_id long, pulled_at timestamp_ntz, point_pos int"


def _batch(spark, path, batch_id, rows):
    spark.createDataFrame(rows, AIR).withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").partitionBy("batch_id").parquet(path)


def _row(device, hour, value, pulled, pos=0, note=None):
    at = None if hour is None else T0 + dt.timedelta(hours=hour, microseconds=7)
    return (device, at, value, note, int(pulled), T0 + dt.timedelta(days=100, seconds=pulled), pos)


def test_late_repeated_and_restarted_pulls_equal_the_batch(spark, tmp_dir):
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    log = f"{base}/air_readings"
    first = [_row(d, h, (d or 0) + h / 7, 50) for d in (1, 2, None) for h in range(30)] + [_row(1, 3, 9.5, 50, pos=1, note='a "b", \n')]
    late = [_row(1, h, -1.0, 20) for h in range(25, 40)] + [_row(2, 5, 5.5, 60), _row(3, None, 1.0, 1), _row(2, 6, None, 61)]
    sent = []
    for i, rows in enumerate((first, late + first[:7], first)):
        _batch(spark, log, i, rows)
        sent += rows
        state.keep_current(spark, base, "air_readings", f"{base}/ckpt").awaitTermination()
        spec = L.TABLES["air_readings"]
        want = L.latest_per_key(spark.createDataFrame(sent, AIR), spec.key, spec.order)
        got = state.current(spark, base, "air_readings")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        files = {r.f for r in got.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
        if i == 1:
            before = files
    assert files == before  # a batch of repeats alone rewrites nothing


def test_newest_keeps_one_version_of_each_key():
    none = np.zeros(0, state._ENTRY)
    keep, seen = state.newest(none, [1, 1, 2, 1], [5, 5, 5, 6], [10, 12, 1, 1], [0, 0, 0, 0])
    assert sorted(keep) == [1, 2, 3] and len(seen) == 3
    keep, seen = state.newest(seen, [1, 2, 2, 3], [5, 5, 5, 0], [12, 0, 1, 1], [0, 9, 1, 0])
    assert sorted(keep) == [2, 3] and len(seen) == 4
    assert len(state.newest(seen, [], [], [], [])[0]) == 0


def test_resume_points_move_forward_only(spark, tmp_dir):
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    shape = "device_type string, device_id long, status string, error_message string, pulled_to timestamp_ntz, batch_id long"

    def at(n):
        return T0 + dt.timedelta(days=n)
    for i, rows in enumerate(([("air", 1, "success", None, at(5), 0), ("air", 2, "failed", "x", at(5), 0), ("wearable", 1, "success", None, at(1), 0)],
                              [("air", 1, "success", None, at(3), 1), ("air", 2, "success", None, at(2), 1), ("wearable", 1, "success", None, at(9), 1)])):
        spark.createDataFrame(rows, shape).write.mode("append").partitionBy("batch_id").parquet(f"{base}/run_log")
        state.keep_resume(spark, base, f"{base}/ckpt").awaitTermination()
        got = {(r.device_type, r.device_id): r.pulled_to for r in state.resume_points(spark, base).collect()}
        assert got == ({("air", 1): at(5), ("wearable", 1): at(1)} if i == 0 else {("air", 1): at(5), ("air", 2): at(2), ("wearable", 1): at(9)})
    raw = spark.createDataFrame([("air", 1, at(5)), ("air", 1, at(6)), ("air", 7, at(0))], "device_type string, device_id long, pulled_at timestamp_ntz")
    assert sorted((r.device_id, r.pulled_at) for r in L.since_last_success(raw, state.resume_points(spark, base)).collect()) == [(1, at(6)), (7, at(0))]


def test_late_rows_are_counted_apart_and_none_is_lost(spark, tmp_dir):
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    rows = [[("air", d, T0 + dt.timedelta(hours=h)) for d in (1, 2) for h in range(0, 24 * 9, 5)],
            [("air", 1, T0 + dt.timedelta(hours=3)), ("air", 3, T0), ("air", 2, T0 + dt.timedelta(days=8)), ("air", 2, T0 + dt.timedelta(days=30)), ("air", 1, None)],
            [("air", 9, T0 + dt.timedelta(days=31)), ("air", 1, T0 + dt.timedelta(days=8))]]
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, "device_type string, device_id long, at timestamp_ntz").write.mode("append").parquet(f"{base}/log")
        log = spark.readStream.schema("device_type string, device_id long, at timestamp_ntz").parquet(f"{base}/log")
        coverage.start_dealing(log, f"{base}/cover", f"{base}/deal").awaitTermination()
        q = coverage.start_counting(spark, f"{base}/cover", f"{base}/count")
        q.awaitTermination()
        assert all(s["numRowsDroppedByWatermark"] == 0 for p in q.recentProgress for s in p["stateOperators"])
    out = coverage.coverage(spark, f"{base}/cover").collect()
    late = {(r.device_id, r.start): r.late for r in out if r.late}
    assert late == {(1, T0): 1, (3, T0): 1, (1, T0 + dt.timedelta(days=8)): 1}
    assert sum(r.readings + r.late for r in out) == sum(map(len, rows)) - 1
    closed = [r for r in out if r.closed and r.readings]
    assert {(r.device_id, r.start) for r in closed} >= {(d, T0 + dt.timedelta(days=k)) for d in (1, 2) for k in range(6)}
    assert {r.readings for r in closed if r.start == T0} == {5}


def test_state_is_held_in_a_fixed_number_of_blocks_a_day(spark, tmp_dir):
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    rows = [_row(d, h, float(d), 50) for d in range(400) for h in (1, 30)]
    _batch(spark, f"{base}/air_readings", 0, rows)
    q = state.keep_current(spark, base, "air_readings", f"{base}/ckpt", buckets=4)
    q.awaitTermination()
    assert sum(o["numRowsTotal"] for o in q.recentProgress[-1]["stateOperators"]) <= 3 * 2 * 4  # value, its expiry index and count, not one per device
    assert state.current(spark, base, "air_readings").count() == len(rows)

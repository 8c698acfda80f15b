"""Decisions D9, D10/D11, D20, D24, D25 and the CSV reader on real files."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from senslake.operators import joins, study
from senslake.operators.filters import valid_coordinates

T0 = dt.datetime(2026, 7, 9, 10, 0)
T1 = dt.datetime(2026, 7, 9, 11, 0)


def test_coordinates_D9(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 88.3), (22.5, 88.3), (None, 88.3)], "lat double, lon double")
    doc = df.where(valid_coordinates(F.col("lat"), F.col("lon"))).count()
    strict = df.where(valid_coordinates(F.col("lat"), F.col("lon"), either_zero=True)).count()
    assert (doc, strict) == (2, 1)


def test_merge_kinds_D10_D11(spark):
    a = spark.createDataFrame([(T0, 1.0), (T1, 2.0)], "datetime timestamp_ntz, a double")
    b = spark.createDataFrame([(T1, 3.0), (None, 4.0)], "datetime timestamp_ntz, b double")
    outer = joins.merge_on_time({"a": a, "b": b})
    assert outer.count() == 3
    assert joins.merge_on_time({"a": a, "b": b}, how="inner").count() == 1
    assert joins.merge_on_time({"a": a, "b": b}, how="left").count() == 2
    fold = joins.merge_on_time({"a": a, "b": b}, how="right")
    assert fold.count() == 2                       # null keys match null-safe, none here in a
    assert joins.merge_on_time({"a": a, "b": b}, how="left_anti").count() == 1
    assert sorted(joins.merge_on_time({"x": a, "y": a}).columns) == ["a_x", "a_y", "datetime"]  # device suffixes
    twice = a.unionByName(spark.createDataFrame([(T1, 9.0)], "datetime timestamp_ntz, a double"))
    got = sorted(map(tuple, joins.merge_on_time({"a": twice, "b": b}, how="inner").select("a", "b").collect()))
    assert got == [(2.0, 3.0), (9.0, 3.0)]         # repeated timestamps multiply, none is lost
    with pytest.raises(ValueError):
        joins.merge_on_time({"a": a, "b": b}, how="cross")


def test_registry_keys_case_insensitive_and_required_D20(spark):
    doc = json.dumps({"wearable_devices": [{"id": "w1", "type": "wearable", "Start_date": "2026-06-15"},
                                           {"type": "wearable"}],
                      "air_devices": [{"id": "a1", "type": "air"}], "version": 1})
    out = {r.device_id: r for r in study.flatten_devices(spark.createDataFrame([(doc,)], "doc string")).collect()}
    assert str(out["w1"].start_date) == "2026-06-15" and out["w1"].valid
    assert out[None].valid is False and out["a1"].valid


def test_overlaps_D25(spark):
    a = spark.createDataFrame(
        [(1, 1, "p1", dt.date(2026, 1, 1), dt.date(2026, 1, 10)),
         (2, 1, "p2", dt.date(2026, 1, 10), None),            # same-day handover: fine
         (3, 1, "p3", dt.date(2026, 1, 12), dt.date(2026, 1, 20)),  # inside p2's open range
         (4, 2, "p4", dt.date(2026, 1, 1), None)],
        "assignment_id long, device_id long, participant_id string, assigned_from date, assigned_until date")
    assert [r.assignment_id for r in study.overlapping_assignments(a).collect()] == [3]


def test_typed_empty_tables_D24(spark):
    from senslake.operators import normalize as N
    from senslake.sources import payloads
    raw = spark.createDataFrame([(1, "wearable", 1, "api_auto", T0, json.dumps({"steps": None}), "UTC")],
                                "ingest_id long, device_type string, device_id long, ingest_method string, "
                                "pulled_at timestamp_ntz, payload string, timezone string")
    pts = payloads.wearable_points(raw)
    for t in (N.readings(pts), N.sleep_sessions(pts), N.exercise_sessions(pts)):
        assert t.count() == 0 and "device_id" in t.columns


def test_csv_reader_on_files(spark, tmp_dir):
    from senslake.sources import csv_export as C
    head = "﻿Date (UTC+05:30),AQS,PM2.5 (µg/m³),Latitude,Longitude,Charging,Motion,User Notes"
    body = ["2026-07-09 15:30:00,12,7.5,22.5,88.3,yes,no,moved, then back",
            "", "2026-07-09 15:31:00,nan,n/a,22.5,88.3",
            "2026-07-09 15:32:00,13,8.0,,,cd,yes,"]
    with open(os.path.join(tmp_dir, "AABBCCDDEEFF_09-Jul-2026_09-Jul-2026.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join([head, *body]) + "\n")
    with open(os.path.join(tmp_dir, "notes.csv"), "w", encoding="utf-8") as f:
        f.write(head + "\n")
    lines = C.read_lines(spark, tmp_dir)
    meta = {r.file_name: r.status for r in C.file_metadata(lines.select("file_name").distinct()).collect()}
    assert sorted(meta.values()) == ["matched", "unmatched"]
    recs = C.to_records(C.split_rows(lines)).orderBy("recorded_at").collect()
    assert len(recs) == 3
    assert str(recs[0].recorded_at) == "2026-07-09 10:00:00" and recs[0].aqs == 12
    assert recs[0].charging is True and recs[0].motion is False
    assert recs[1].aqs is None and recs[1].pm25 is None and recs[1].charging is False
    assert recs[2].recently_charged is True and recs[2].latitude is None


def test_json_column_is_found_behind_rows_that_are_not_json(spark):
    from senslake.operators import legacy
    rows = [(i, "plain" if i < 120 else '{"pm25": 1}') for i in range(400)]
    assert legacy.detect_json_column(spark.createDataFrame(rows, "id int, blob string")) == "blob"


def test_unknown_zone_is_null_not_an_error(spark):
    from senslake.functions.time import local_to_utc
    df = spark.createDataFrame([("2024-01-01T00:00:00", "Asia/Dhaka"), ("2024-01-01T00:00:00", "Mars/Base")], "s string, tz string")
    got = [r.u for r in df.select(local_to_utc(F.col("s"), F.col("tz")).alias("u")).collect()]
    assert got[0].hour == 18 and got[1] is None


def test_air_values_times_and_payloads_fail_only_their_device(spark):
    from senslake.sinks import load as L
    from senslake.sources import payloads
    good = '{"mac": "m", "merged_data": [{"date": "2026-07-09T10:00:00Z", "aqs": 85.0, "co2": "400", "pm1": "1.5", "motion": true}]}'
    rows = [(1, good), (2, good.replace("85.0", '"high"')), (3, good.replace("2026-07-09T10:00:00Z", "soon")), (4, "{broken"),
            (5, '{"merged_data": "none"}'), (6, '{"mac": "m"}'), (7, None)]
    raw = spark.createDataFrame([(i, "air", p) for i, p in rows], "device_id long, device_type string, payload string").selectExpr(
        "device_id AS ingest_id", "device_type", "device_id", "'api_auto' AS ingest_method", "timestamp_ntz'2026-07-10 00:00:00' AS pulled_at", "payload", "'UTC' AS timezone")
    rec = {r.device_id: r for r in payloads.air_records(raw).collect()}
    assert (rec[1].aqs, rec[1].co2, rec[1].pm1, rec[1].motion, rec[1].bad_fields) == (85, 400, 1.5, True, None)
    assert rec[2].aqs is None and rec[2].bad_fields == "aqs"
    out = L.load_air_batch(raw)
    assert [r.device_id for r in out["air_readings"].collect()] == [1]
    assert {r.device_id: r.error_message for r in out["run_log"].collect()} == {
        1: None, 2: "bad value: aqs", 3: "unreadable time: soon", 4: "payload: not a JSON object", 5: "payload: merged_data is not a list",
        6: None, 7: "payload: not a JSON object"}


def test_csv_header_anywhere_and_rejects(spark):
    from senslake.registry import CSV_COLUMNS
    from senslake.sources import csv_export as C
    name = next(iter(CSV_COLUMNS))
    lines = spark.createDataFrame([("a.csv", f"\ufeff{name}, Date (UTC+05:30),Notes"), ("a.csv", "7,2026-07-09 15:30:00,note, Date (UTC said"),
                                   ("b.csv", "x,y"), ("b.csv", "1,2")], "file_name string, line string")
    rows = C.to_records(C.split_rows(lines), keep=("date_idx",)).collect()
    assert [(r.file_name, r.date_idx, str(r.recorded_at)) for r in rows] == [("a.csv", 2, "2026-07-09 10:00:00")]
    assert [tuple(r) for r in C.rejected_files(lines).collect()] == [("b.csv", "no date header")]


def test_merges_of_many_tables_are_one_exchange(spark):
    rows = lambda name, data: spark.createDataFrame(data, f"device long, datetime timestamp_ntz, {name} int, same int")
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    tables = {"a": rows("a", [(1, t[0], 1, 0), (1, t[0], 2, 0), (1, None, 3, 0), (2, t[2], None, None)]), "b": rows("b", [(1, t[0], 4, 1), (1, t[0], 5, 1), (1, None, 6, 1)]),
              "c": rows("c", [(1, t[0], 7, 2), (1, t[1], 8, 2), (None, t[1], 9, 2)])}
    for how in ("outer", "left", "inner"):
        out = joins.merge_on_time(tables, keys=("device",), how=how)
        frames = [f.withColumnRenamed("same", f"same_{n}") for n, f in tables.items()]
        want = joins.join_null_safe(joins.join_null_safe(frames[0], frames[1], ["device", "datetime"], how), frames[2], ["device", "datetime"], how)
        assert sorted(map(str, out.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    long = spark.createDataFrame([(1, t[0], "a", 1.0), (1, t[0], "a", None), (1, t[0], "b", 3.0), (1, t[1], "z", 1.0)], "device long, datetime timestamp_ntz, column string, value double")
    assert sorted(map(str, joins.merge_long(long, ["a", "b"], keys=("device",)).collect())) == sorted(
        f"Row(device=1, datetime={t[0]!r}, a={a}, b=3.0)" for a in (1.0, None))


def test_interval_join_gives_each_pair_once_whatever_the_cell(spark):
    import random
    rng = random.Random(4)
    day = lambda n: dt.date(2023, 12, 25) + dt.timedelta(days=n)
    reads = [(rng.randrange(3), None if i == 9 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(900)), i) for i in range(150)]
    periods = [(rng.randrange(3), day(a), None if a % 3 == 0 else day(a + rng.randrange(-2, 40)), a) for a in range(-400, 60, 9)] + [(1, None, day(9), 999)]
    r = spark.createDataFrame(reads, "device_id long, recorded_at timestamp_ntz, n int")
    p = spark.createDataFrame(periods, "device_id long, assigned_from date, assigned_until date, m int")
    want = sorted((n, m) for d, t, n in reads for e, a, b, m in periods if t and d == e and a and a <= t.date() and (b is None or t.date() < b))
    for cell in (1, 7, 400):
        assert sorted((x.n, x.m) for x in joins.interval_join(r, p, cell_days=cell).collect()) == want
    left = joins.interval_join(r, p, how="left").collect()
    assert len(left) == len(want) + 150 - len({n for n, _ in want}) and joins.interval_join(r.limit(0), p).count() == 0


def test_interval_join_counts_exploded_periods_before_it_broadcasts(spark):
    import datetime as dt

    from senslake.operators.joins import interval_join
    r = spark.range(40).selectExpr("id % 4 AS device_id", "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS recorded_at", "id")
    p = spark.createDataFrame([(d, dt.date(2024, 1, 3 + d), None if d else dt.date(2024, 2, 1)) for d in range(3)], "device_id long, assigned_from date, assigned_until date")
    plans, rows = [], []
    for limit in (5, 1000):
        out = interval_join(r, p, how="left", limit=limit)
        rows.append(sorted(map(str, out.collect())))
        plans.append(out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().sparkPlan().toString())
    assert rows[0] == rows[1] and len(rows[0]) == 40
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" in plans[1]

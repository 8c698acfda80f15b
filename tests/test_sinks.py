"""Run lifecycle and the upsert of touched partitions."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from senslake.sinks import load as L
from senslake.sinks import partitioned as P
from senslake.sinks import runs as R

T0 = dt.datetime(2026, 7, 9, 10, 0)
RAW = "ingest_id long, device_type string, device_id long, ingest_method string, pulled_at timestamp_ntz, payload string, timezone string"
READ = "device_id long, recorded_at timestamp_ntz, value double, pulled_at timestamp_ntz, point_pos int"


def _steps(n):
    point = {"steps": {"interval": {"startTime": f"2026-07-09T15:{n:02d}:00Z", "endTime": f"2026-07-09T15:{n + 1:02d}:00Z"}, "count": "3"}}
    return json.dumps({"steps": {"dataPoints": [point]}})


def _air(value):
    return json.dumps({"mac": "AA", "merged_data": [{"date": "2026-07-09T15:31:00Z", "pm25": value}] * 2})


@pytest.fixture
def raw(spark):
    rows = [(1, "wearable", 1, "api_auto", T0, _steps(1), "UTC"), (2, "wearable", 1, "api_auto", T0 + dt.timedelta(hours=1), _steps(1), "UTC"),
            (3, "wearable", 2, "api_auto", T0, "{cut", "UTC"), (4, "air", 2, "api_auto", T0, _air(4.5), "UTC"), (5, "air", 3, "api_auto", T0, _air("x"), None)]
    return spark.createDataFrame(rows, RAW)


def test_a_run_starts_ends_and_counts(spark, raw, tmp_dir):
    log, stored = f"{tmp_dir}/{uuid.uuid4().hex}", {}
    totals = R.tracked_load(raw, log, "2026-07-09", lambda name, rows: stored.update({name: rows.count()}))
    got = {(r.device_type, r.device_id): r for r in R.runs(spark, log).collect()}
    assert {k: (r.status, r.rows, r.duplicates) for k, r in got.items()} == {
        ("wearable", 1): ("success", 1, 1), ("wearable", 2): ("failed", 0, 0), ("air", 2): ("success", 1, 1), ("air", 3): ("failed", 0, 0)}
    assert got["wearable", 2].error_message == "payload: not a JSON object" and got["air", 3].error_message.startswith("bad value")
    assert all(r.ended_at >= r.started_at for r in got.values()) and got["air", 2].run_id == "2026-07-09"
    assert totals["readings"] == {"rows": 1, "duplicates": 1} and stored["air_readings"] == 1
    assert {(r.table_name, r.rows, r.duplicates) for r in R.run_totals(spark, log).collect()} >= {("readings", 1, 1), ("air_readings", 1, 1), ("profile", 0, 0)}


def test_a_killed_load_stays_running_until_it_is_run_again(spark, raw, tmp_dir):
    log = f"{tmp_dir}/{uuid.uuid4().hex}"

    def dies(name, rows):
        raise InterruptedError
    with pytest.raises(InterruptedError):
        R.tracked_load(raw, log, "a", dies)
    assert {(r.status, r.ended_at, r.rows) for r in R.runs(spark, log).collect()} == {("running", None, None)}
    R.tracked_load(raw, log, "a", lambda name, rows: None)
    assert sorted(r.status for r in R.runs(spark, log).collect()) == ["failed", "failed", "success", "success"]


def _rows(spark, rows):
    return spark.createDataFrame([(d, None if day is None else dt.datetime(2024, 1, day, 5), v, T0 + dt.timedelta(seconds=s), 0) for d, day, v, s in rows], READ)


def test_a_one_day_pull_rewrites_one_day(spark, tmp_dir):
    path = f"{tmp_dir}/{uuid.uuid4().hex}"
    spec = L.TableSpec("t", ("device_id", "recorded_at"), buckets=2)

    def files():
        return {(str(r.day), r.bucket, r.f) for r in table().select("day", "bucket", F.col("_metadata.file_path").alias("f")).distinct().collect()}

    def table():
        return P.read_days(spark, path, first.schema)
    first = _rows(spark, [(d, day, 1.0, 10) for d in range(20) for day in range(1, 6)] + [(1, None, 0.5, 10)])
    assert len(P.merge_days(first, path, spec)) == 11
    before = files()
    assert P.merge_days(_rows(spark, [(1, 3, 2.0, 20), (77, 3, 3.0, 20), (2, 3, 9.0, 5)]), path, spec) == sorted({f"2024-01-03/{b}" for b in (0, 1)})
    changed = {(d, b) for d, b, _ in files() ^ before}
    assert {d for d, _ in changed} == {"2024-01-03"} and table().count() == 102
    value = {(r.device_id, r.recorded_at and r.recorded_at.day): r.value for r in table().collect()}
    assert value[1, 3] == 2.0 and value[77, 3] == 3.0 and value[2, 3] == 1.0  # an older version does not win
    P.merge_days(_rows(spark, [(1, None, 0.7, 20)]), path, spec)
    assert {r.value for r in table().where("day is null").collect()} == {0.7}
    assert P.merge_days(first.limit(0), path, spec) == [] and len(files()) == len(before)
    plan = P.touched(table(), ["2024-01-03/0"])._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "day" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_landed_scan_reads_the_partitions_it_needs(spark, tmp_dir):
    from senslake.sources import payloads
    path = f"{tmp_dir}/{uuid.uuid4().hex}"
    rows = [(t * 1000 + d * 10 + day, ("air", "wearable")[t], d, "api_auto", dt.datetime(2024, 1, day, 3), "{}", "UTC") for t in (0, 1) for d in range(30) for day in range(1, 8)]
    raw = spark.createDataFrame(rows, RAW)
    payloads.land_raw(raw.where("pulled_at < '2024-01-05'"), path)
    payloads.land_raw(raw.where("pulled_at >= '2024-01-05'"), path)
    landed = payloads.read_raw(spark, path)

    def scan(df):
        plan = df._jdf.queryExecution().executedPlan()
        while plan.children().size():
            plan = plan.children().head()
        return plan

    def files_read(df):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            kept = sorted(map(str, df.select(*raw.columns).collect()))
            out = df.select(*raw.columns)
            out._jdf.queryExecution().executedPlan().executeCollect()
            return kept, scan(out).metrics().apply("numFiles").value(), scan(out).toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    everything, total, _ = files_read(landed)
    assert everything == sorted(map(str, raw.collect()))
    kept, some, plan = files_read(payloads.raw_by_device(landed, device_type="air", device_ids=[3, 4], since="2024-01-06 01:00:00"))
    assert kept == sorted(map(str, payloads.raw_by_device(raw, device_type="air", device_ids=[3, 4], since="2024-01-06 01:00:00").collect())) and len(kept) == 4
    assert some <= total * 2 // 14 + 1 and "device_type" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "In(device_id" in plan
    wanted = spark.createDataFrame([("air", 3), ("air", 99)], "device_type string, device_id long")
    assert sorted(r.ingest_id for r in payloads.raw_by_device(landed, device_ids=wanted).collect()) == [30 + d for d in range(1, 8)]

"""Load semantics: upsert (D1, D2), isolation (D13), FK resolution (D18)."""

import datetime as dt

from senslake.sinks import load as L

T0 = dt.datetime(2026, 7, 9, 10, 0)
T1 = dt.datetime(2026, 7, 9, 11, 0)


def _rows(spark, data):
    return spark.createDataFrame(data, "device_id long, tag string, value double, pulled_at timestamp_ntz, "
                                       "point_pos int")


def test_null_safe_key_D1_and_latest_wins_D2(spark):
    src = _rows(spark, [(1, None, 1.0, T0, 0), (1, None, 2.0, T1, 0), (1, None, 3.0, T1, 1),
                        (1, "a", 9.0, T0, 0)])
    out = {(r.tag, r.value) for r in L.latest_per_key(src, ["device_id", "tag"],
                                                      ["pulled_at", "point_pos"]).collect()}
    assert out == {(None, 3.0), ("a", 9.0)}


def test_upsert_source_beats_target_and_is_idempotent(spark):
    target = _rows(spark, [(1, "a", 1.0, T1, 5), (2, "b", 2.0, T0, 0)])
    source = _rows(spark, [(1, "a", 10.0, T0, 0), (3, "c", 3.0, T0, 0)])
    once = L.upsert(target, source, ["device_id", "tag"], ["pulled_at", "point_pos"])
    twice = L.upsert(once, source, ["device_id", "tag"], ["pulled_at", "point_pos"])
    got = sorted((r.device_id, r.value) for r in once.collect())
    assert got == [(1, 10.0), (2, 2.0), (3, 3.0)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_insert_if_absent(spark):
    t = spark.createDataFrame([(1, "old")], "id long, notes string")
    s = spark.createDataFrame([(1, "new"), (2, "new")], "id long, notes string")
    assert sorted(map(tuple, L.insert_if_absent(t, s, ["id"]).collect())) == [(1, "old"), (2, "new")]


def test_failure_isolation_D13(spark):
    r = spark.createDataFrame([(1, None), (1, "bad"), (2, None)], "device_id long, error string")
    failed = L.failed_devices(r)
    assert [x.device_id for x in failed.collect()] == [1]
    assert [x.device_id for x in L.isolate(r, failed).collect()] == [2]
    log = L.run_log(spark.createDataFrame([("w", 1), ("w", 2)], "device_type string, device_id long"), failed)
    assert {(x.device_id, x.status) for x in log.collect()} == {(1, "failed"), (2, "success")}


def test_stage_without_session_is_rejected_D18(spark):
    sessions = spark.createDataFrame([(1, T0)], "device_id long, started_at timestamp_ntz")
    stages = spark.createDataFrame([(1, T0, T0), (1, T1, T1)],
                                   "device_id long, session_started_at timestamp_ntz, started_at timestamp_ntz")
    ok, bad = L.resolve_stages(stages, sessions)
    assert ok.count() == 1 and bad.count() == 1


def test_raw_append_is_append_only(spark, tmp_dir):
    raw = spark.createDataFrame([("wearable", 1, T0, "{}")],
                                "device_type string, device_id long, pulled_at timestamp_ntz, payload string")
    L.write_raw(raw, f"{tmp_dir}/raw")
    L.write_raw(raw, f"{tmp_dir}/raw")
    back = spark.read.parquet(f"{tmp_dir}/raw")
    assert back.count() == 2 and back.select("ingest_id").distinct().count() == 1


def test_parser_registry_routes_and_reports(spark):
    import json
    from senslake.operators import parsers
    p = json.dumps({"steps": {"dataPoints": [{"steps": {"interval": {"startTime": "2026-07-09T15:31:00Z",
                                                                     "endTime": "2026-07-09T15:32:00Z"},
                                                        "count": "3"}}]}})
    a = json.dumps({"mac": "AA", "merged_data": [{"date": "2026-07-09T15:31:00Z", "pm25": 4.5}]})
    raw = spark.createDataFrame(
        [(1, "wearable", 1, "api_auto", T0, p, "UTC"), (2, "air", 2, "api_auto", T0, a, "UTC"),
         (3, "thermostat", 3, "api_auto", T0, "{}", None)],
        "ingest_id long, device_type string, device_id long, ingest_method string, pulled_at timestamp_ntz, "
        "payload string, timezone string")
    out = L.load_batch(raw)
    assert out["readings"].count() == 1 and out["air_readings"].first().pm25 == 4.5
    assert [r.device_id for r in out["unrouted"].collect()] == [3]
    assert sorted(map(tuple, out["run_log"].drop("pulled_to").collect())) == [("air", 2, "success", None), ("wearable", 1, "success", None)]
    assert [(r.device_type, r.ingests) for r in parsers.unregistered(raw).collect()] == [("thermostat", 1)]


def test_insert_if_absent_takes_one_row_per_new_key(spark):
    t = spark.createDataFrame([(None, "old")], "id int, v string")
    s = spark.createDataFrame([(2, "b"), (2, "a"), (None, "x")], "id int, v string")
    assert sorted(map(tuple, L.insert_if_absent(t, s, ["id"]).collect()), key=str) == [(2, "a"), (None, "old")]


def test_tables_are_written_as_versions(spark, tmp_dir):
    spec = L.TableSpec("t", ("device_id", "tag"), ("tag",))
    path = f"{tmp_dir}/t"
    assert L.read_table(spark, path) is None
    assert L.merge_table(_rows(spark, [(1, "a", 1.0, T0, 0), (2, "b", 2.0, T0, 0)]), path, spec) == 1
    again = _rows(spark, [(1, "a", 5.0, T1, 0), (3, "c", 3.0, T1, 0)])
    assert L.merge_table(again, path, spec) == 2 and L.merge_table(again, path, spec) == 3
    new = sorted((r.device_id, r.value) for r in L.read_table(spark, path).collect())
    assert new == [(1, 5.0), (2, 2.0), (3, 3.0)] and L.read_table(spark, path, 1).count() == 2
    again.write.parquet(f"{path}/version=4/_temporary")  # a write that died before its commit
    assert L.read_table(spark, path).count() == 3


def test_session_keys_name_null_parts(spark):
    rows = spark.createDataFrame([(1, T0), (1, None), (None, T0), (1, T0)], "device_id long, started_at timestamp_ntz")
    ids = [r.session_id for r in L.session_ids(rows).collect()]
    assert len(set(ids)) == 3 and None not in ids


def test_landed_frames_split_and_parsed_tables_are_scans(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from senslake.plans import model
    from senslake.session import ROW_GROUP, write_split
    wide = spark.range(60_000).repartition(1).withColumn("payload", F.concat_ws(" ", *[F.sha2(F.concat(F.lit(i), "id"), 256) for i in range(4)]))
    write_split(wide, f"{tmp_dir}/wide")
    file = pq.ParquetFile(glob.glob(f"{tmp_dir}/wide/*.parquet")[0]).metadata
    assert file.num_row_groups > 2 and max(file.row_group(i).total_byte_size for i in range(file.num_row_groups)) < 2 * ROW_GROUP
    parsed = L.load_batch(model.pulls(spark, "/root/testdata/sf0.001"))["parsed"]
    for name in ("readings", "sleep_stages", "air_readings"):
        assert "Generate" not in parsed[name]._jdf.queryExecution().executedPlan().toString()

"""Registered queries: raw log, failure isolation, upsert, FK resolution, run log."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from senslake.operators import air
from senslake.operators import normalize as N
from senslake.operators.parsers import PARSERS
from senslake.plans import model
from senslake.plans.q_wearable import points, readings
from senslake.plans.registry import query, rounded
from senslake.plans.sql_common import (A_RAW, AEV, DEVICES, READINGS_COLS, W_FAILED, W_ITEMS, W_POINTS, W_RAW,
                                       W_READINGS, WEV, with_)
from senslake.registry import INGEST_METHODS
from senslake.session import checkpoint_dir, materialize
from senslake.sinks import load as L
from senslake.sinks import runs as R
from senslake.sinks.partitioned import merge_days, placed, read_days
from senslake.sources import payloads

_W = with_(DEVICES, WEV, W_ITEMS, W_READINGS, W_FAILED, W_RAW)
# Both device types: pulls, and the devices that fail, as a whole batch and for themselves.
_BOTH = with_(DEVICES, WEV, W_ITEMS, W_READINGS, W_FAILED, W_RAW, AEV, A_RAW, """
raw AS (SELECT ingest_id, device_type, device_id, ingest_method, pulled_at FROM w_raw
        UNION ALL SELECT ingest_id, device_type, device_id, ingest_method, pulled_at FROM a_raw),
failed AS (SELECT 'wearable' AS device_type, device_id, error_message FROM w_failed
           UNION ALL SELECT DISTINCT 'air', device_id, 'payload: not a JSON object' FROM a_raw WHERE broken)""")
_KEY = list(L.TABLES["readings"].key)
_TABLE = ["device_id", "data_type", "grain", "recorded_at", "ended_at", "metric", "tag",
          "value_numeric", "value_text", "ingest_id"]


def _batch(spark, sf_dir):
    return L.load_batch(model.pulls(spark, sf_dir))


def _wearable(spark, sf_dir):
    return L.load_type("wearable", model.pulls(spark, sf_dir).where("device_type = 'wearable'"))


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("snk1_raw_ingests", sql=_BOTH + """
SELECT device_type, ingest_method, count(*) AS ingests, min(pulled_at) AS first_pull, max(pulled_at) AS last_pull
FROM raw GROUP BY 1, 2
""")
def snk1_raw_ingests(spark, sf_dir):
    """The append-only raw log, written in two appends and read back, summarised per (device_type, ingest_method)."""
    raw, path = model.pulls(spark, sf_dir), _folder(spark, "raw")
    for part in (F.col("ingest_id") % 2 == 0, F.col("ingest_id") % 2 == 1):
        L.write_raw(raw.where(part), path)
    return spark.read.parquet(path).groupBy("device_type", "ingest_method").agg(
        F.count("*").alias("ingests"), F.min("pulled_at").alias("first_pull"),
        F.max("pulled_at").alias("last_pull"))


@query("flt4_ingest_method_check", sql=_BOTH + """
SELECT ingest_id, device_type, device_id, ingest_method FROM raw
WHERE ingest_method NOT IN ('api_auto', 'api_manual', 'csv_manual', 'test_script')
""")
def flt4_ingest_method_check(spark, sf_dir):
    """Raw ingests whose method is outside the allowed set (rejects)."""
    raw = model.pulls(spark, sf_dir)
    return raw.where(~F.coalesce(F.col("ingest_method").isin(INGEST_METHODS), F.lit(False))).select(
        "ingest_id", "device_type", "device_id", "ingest_method")


@query("snk6_run_log", sql=_BOTH + """
SELECT d.device_type, d.device_id, CASE WHEN f.device_id IS NULL THEN 'success' ELSE 'failed' END AS status, f.error_message
FROM (SELECT DISTINCT device_type, device_id FROM raw) d LEFT JOIN failed f USING (device_type, device_id)
""")
def snk6_run_log(spark, sf_dir):
    """Per device of the batch: success, or failed with the first error."""
    return _batch(spark, sf_dir)["run_log"].drop("pulled_to")


_RUNS_SQL = _BOTH + """
, run_of AS (SELECT *, CASE WHEN day(pulled_at) <= 10 THEN 'run-1' WHEN day(pulled_at) <= 20 THEN 'run-2' ELSE 'run-3' END AS run_id FROM raw)
, bad AS (
  SELECT DISTINCT p.run_id, p.device_type, p.device_id, min(e.error) OVER (PARTITION BY p.run_id, p.device_type, p.device_id) AS error_message
  FROM run_of p JOIN (SELECT ingest_id, error FROM w_readings WHERE error IS NOT NULL
                      UNION ALL SELECT ingest_id, 'payload: not a JSON object' FROM a_raw WHERE broken) e USING (ingest_id))
, keys AS (
  SELECT ingest_id, 'r' AS t, struct_pack(data_type, recorded_at, metric, tag)::VARCHAR AS k FROM w_readings
  UNION ALL SELECT event_id, 's', ts::VARCHAR FROM wev WHERE event_type = 'error'
  UNION ALL SELECT event_id, 'e', ts::VARCHAR FROM wev WHERE event_type = 'purchase'
  UNION ALL SELECT event_id, 'p', ts::VARCHAR FROM wev WHERE event_type = 'signup'
  UNION ALL SELECT ingest_id, 'a', ts::VARCHAR FROM arec WHERE ingest_id % 41 <> 0)
, counted AS (
  SELECT run_id, device_type, device_id, count(*) AS parsed, count(DISTINCT t || k) AS stored
  FROM keys JOIN run_of USING (ingest_id) GROUP BY 1, 2, 3)
SELECT d.run_id, d.device_type, d.device_id,
       CASE WHEN d.run_id = 'run-3' THEN 'running' WHEN b.device_id IS NULL THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN d.run_id <> 'run-3' THEN b.error_message END AS error_message,
       CASE WHEN d.run_id <> 'run-3' THEN CASE WHEN b.device_id IS NULL THEN coalesce(c.stored, 0) ELSE 0 END END AS rows,
       CASE WHEN d.run_id <> 'run-3' THEN CASE WHEN b.device_id IS NULL THEN coalesce(c.parsed - c.stored, 0) ELSE 0 END END AS duplicates,
       TIMESTAMP '2024-02-01' AS started_at, CASE WHEN d.run_id <> 'run-3' THEN TIMESTAMP '2024-02-01 01:00:00' END AS ended_at
FROM (SELECT DISTINCT run_id, device_type, device_id FROM run_of) d
LEFT JOIN bad b USING (run_id, device_type, device_id) LEFT JOIN counted c USING (run_id, device_type, device_id)
"""


@query("snk6_run_lifecycle", sql=_RUNS_SQL)
def snk6_run_lifecycle(spark, sf_dir):
    """Three tracked loads of the month's pulls; the third is killed while it writes, so its devices stay running."""
    raw, log = model.pulls(spark, sf_dir), _folder(spark, "runs")
    day = F.dayofmonth("pulled_at")
    at, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-02-01 00:00:00", "2024-02-01 01:00:00"))

    def store(name, rows):
        rows.write.format("noop").mode("overwrite").save()

    def dies(name, rows):
        raise InterruptedError("killed")

    for run, part, sink in (("run-1", day <= 10, store), ("run-2", (day > 10) & (day <= 20), store), ("run-3", day > 20, dies)):
        try:
            R.tracked_load(raw.where(part), log, run, sink, at=at, end_at=end)
        except InterruptedError:
            pass
    return R.runs(spark, log)


_UPSERT_SQL = _W + f"""
, loaded AS (
  SELECT r.*, w.pulled_at, 0 AS point_pos FROM w_readings r JOIN w_raw w USING (ingest_id)
  WHERE r.device_id NOT IN (SELECT device_id FROM w_failed)
), versions AS (
  SELECT *, 0 AS src FROM loaded WHERE pulled_at < TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT *, 1 AS src FROM loaded WHERE pulled_at >= TIMESTAMP '2024-01-10'
), merged AS (
  SELECT * FROM versions
  QUALIFY row_number() OVER (PARTITION BY device_id, data_type, recorded_at, metric, tag
                             ORDER BY src DESC, pulled_at DESC, point_pos DESC) = 1
)
SELECT {READINGS_COLS.replace(', error', '')} FROM merged
"""


@query("snk2_upsert_readings", sql=_UPSERT_SQL)
def snk2_upsert_readings(spark, sf_dir):
    """Upsert of a second, overlapping pull (pulled from Jan 10) into the
    table loaded by a first pull (before Jan 16): new keys inserted, existing
    keys replaced, null tags matched null-safe, in-batch duplicates resolved
    by latest pull then position. Failed devices load nothing."""
    b = _wearable(spark, sf_dir)
    ok = L.isolate(b["parsed"]["readings"], b["failed"]).drop("error")
    cols = [*_TABLE, "pulled_at", "point_pos"]
    first = ok.where(F.col("pulled_at") < F.lit("2024-01-16").cast("timestamp_ntz")).select(*cols)
    second = ok.where(F.col("pulled_at") >= F.lit("2024-01-10").cast("timestamp_ntz")).select(*cols)
    target = L.latest_per_key(first, _KEY, ["pulled_at", "point_pos"])
    merged = L.upsert(target, second, _KEY, ["pulled_at", "point_pos"])
    return rounded(merged.select(*_TABLE))


@query("win3_last_writer_wins", sql=_W + """
, loaded AS (SELECT r.*, w.pulled_at FROM w_readings r JOIN w_raw w USING (ingest_id))
SELECT device_id, data_type, recorded_at, metric, tag, count(*) AS versions,
       arg_max(ingest_id, pulled_at) AS winner_ingest_id
FROM loaded GROUP BY device_id, data_type, recorded_at, metric, tag HAVING count(*) > 1
""")
def win3_last_writer_wins(spark, sf_dir):
    """Keys written more than once in the batch and the version that wins."""
    r = readings(spark, sf_dir)
    return (r.groupBy(*_KEY).agg(F.count("*").alias("versions"),
                                 F.max_by("ingest_id", F.struct("pulled_at", "point_pos"))
                                 .alias("winner_ingest_id"))
            .where(F.col("versions") > 1))


@query("snk3_insert_if_absent", sql=with_(DEVICES) + """
SELECT device_id, device_type, 'seed' AS notes FROM devices WHERE device_id % 2 = 0
UNION ALL
SELECT device_id, device_type, 'reseed' FROM devices WHERE device_id % 2 = 1
""")
def snk3_insert_if_absent(spark, sf_dir):
    """Re-seeding the device dimension: existing ids keep their row."""
    d = model.devices(spark, sf_dir).select("device_id", "device_type")
    target = d.where(F.col("device_id") % 2 == 0).withColumn("notes", F.lit("seed"))
    source = d.withColumn("notes", F.lit("reseed"))
    return L.insert_if_absent(target, source, ["device_id"])


@query("snk4_profile_snapshot", sql=_W + """
SELECT device_id, ts + INTERVAL 1 HOUR AS recorded_at, 20 + k % 50 AS age,
       CASE WHEN k % 4 <> 0 THEN make_date(2020 + k % 4, 1 + k % 12, 1 + k % 28) END AS membership_start_date,
       700 + k AS walking_stride_mm, 900 + k AS running_stride_mm
FROM wev WHERE event_type = 'signup' AND device_id NOT IN (SELECT device_id FROM w_failed)
""")
def snk4_profile_snapshot(spark, sf_dir):
    """Profile snapshots stamped with the pull time, failed devices excluded."""
    return _wearable(spark, sf_dir)["profile"]


@query("jn1_stage_session", sql=_W + """
SELECT device_id, ts AS session_started_at, ts + t.s * INTERVAL 1 MINUTE AS started_at,
       ts + t.e * INTERVAL 1 MINUTE AS ended_at, t.typ AS stage_type
FROM wev, (VALUES (0, 60, 'LIGHT'), (60, 180, 'DEEP')) t(s, e, typ)
WHERE event_type = 'error' AND device_id NOT IN (SELECT device_id FROM w_failed)
""")
def jn1_stage_session(spark, sf_dir):
    """Stages resolved to their loaded parent session (device, session start)."""
    b = _wearable(spark, sf_dir)
    resolved, _ = L.resolve_stages(L.isolate(b["parsed"]["sleep_stages"], b["failed"]), b["sleep_sessions"])
    return resolved.select("device_id", "session_started_at", "started_at", "ended_at", "stage_type")


@query("win6_surrogate_key", sql=_W + """
SELECT DISTINCT md5(device_id || '|' || epoch_us(ts)) AS session_id, device_id, ts AS started_at
FROM wev WHERE event_type = 'error' AND device_id NOT IN (SELECT device_id FROM w_failed)
""")
def win6_surrogate_key(spark, sf_dir):
    """Sessions keyed by the MD5 of (device_id, started_at): stable across re-pulls."""
    s = _wearable(spark, sf_dir)["sleep_sessions"]
    return L.session_ids(s).select("session_id", "device_id", "started_at")


@query("jn2_ingest_link", sql=_BOTH + """
SELECT device_type, device_id, count(*) AS rows, count(DISTINCT ingest_id) AS ingests
FROM (SELECT 'wearable' AS device_type, device_id, ingest_id FROM w_readings
      UNION ALL SELECT 'air', device_id, ingest_id FROM arec WHERE ingest_id % 41 <> 0) GROUP BY 1, 2
""")
def jn2_ingest_link(spark, sf_dir):
    """Parsed rows linked back to their raw ingest on (device_type, device_id, pulled_at)."""
    raw = model.pulls(spark, sf_dir)
    cols = ["device_id", "pulled_at"]
    parsed = {t: PARSERS[t](raw.where(F.col("device_type") == t)) for t in PARSERS}
    rows = reduce(DataFrame.unionByName, [parsed[t][name].select(F.lit(t).alias("device_type"), *cols)
                                          for t, name in (("wearable", "readings"), ("air", "air_readings"))])
    ids = L.with_ingest_id(raw).select("device_type", *cols, "ingest_id")
    j = rows.join(ids, ["device_type", *cols], "inner")
    return j.groupBy("device_type", "device_id").agg(F.count("*").alias("rows"),
                                                     F.count_distinct("ingest_id").alias("ingests"))


@query("jn10_fk_violations", sql="""
SELECT 'events.user_id -> customer' AS fk, count(*) AS violations
FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT 'orders.o_custkey -> customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT 'lineitem.l_orderkey -> orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
""")
def jn10_fk_violations(spark, sf_dir):
    """Readings without a device, sessions without a device, stages without a session."""
    from senslake.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events")
    cu = read_table(spark, sf_dir, "customer")
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    parts = [("events.user_id -> customer", L.fk_violations(ev, cu, ["user_id"], ["c_custkey"])),
             ("orders.o_custkey -> customer", L.fk_violations(o, cu, ["o_custkey"], ["c_custkey"])),
             ("lineitem.l_orderkey -> orders", L.fk_violations(li, o, ["l_orderkey"], ["o_orderkey"]))]
    out = None
    for name, df in parts:
        c = df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("fk"), "violations")
        out = c if out is None else out.unionByName(c)
    return out


@query("jn11_expected_vs_stored", sql=_BOTH + """
, keys AS (
  SELECT 'readings' AS table_name, 'wearable' AS device_type, device_id, CAST(struct_pack(data_type, recorded_at, metric, tag) AS VARCHAR) AS key
  FROM w_readings
  UNION ALL
  SELECT CASE event_type WHEN 'error' THEN 'sleep_sessions' WHEN 'signup' THEN 'profile' ELSE 'exercise_sessions' END, 'wearable', device_id, CAST(ts AS VARCHAR)
  FROM wev WHERE event_type IN ('error', 'purchase', 'signup')
  UNION ALL
  SELECT 'sleep_stages', 'wearable', device_id, ts || ' ' || t.s FROM wev, (VALUES (0), (60)) t(s) WHERE event_type = 'error'
  UNION ALL
  SELECT 'air_readings', 'air', device_id, CAST(ts AS VARCHAR) FROM arec WHERE ingest_id % 41 <> 0
), counted AS (
  SELECT table_name, device_id, count(*) AS expected,
         CASE WHEN (device_type, device_id) IN (SELECT (device_type, device_id) FROM failed) THEN 0 ELSE count(DISTINCT key) END AS stored
  FROM keys GROUP BY table_name, device_type, device_id)
SELECT table_name, device_id, expected, stored, CASE WHEN stored = expected THEN 'equal' ELSE 'less' END AS status
FROM counted
""")
def jn11_expected_vs_stored(spark, sf_dir):
    """Parser rows vs stored rows per table (all six, both device types) and device (dedup and failures make 'less')."""
    b = _batch(spark, sf_dir)
    stages = b["sleep_stages"].join(L.session_ids(b["sleep_sessions"]).select("session_id", "device_id"), "session_id")
    stored = {**b, "sleep_stages": stages}

    def rows(tables):
        return reduce(DataFrame.unionByName, [tables[t].select(F.lit(t).alias("table_name"), "device_id")
                                              for t in b["parsed"]])
    return L.expected_vs_stored(rows(b["parsed"]), rows(stored), ["table_name", "device_id"])


@query("flt7_required_fields", sql=_W + """
SELECT count(*) AS rows, count(*) - count(recorded_at) AS recorded_at_missing,
       count(*) - count(device_id) AS device_id_missing, count(*) - count(metric) AS metric_missing
FROM w_readings
""")
def flt7_required_fields(spark, sf_dir):
    """Violations of the required (non-null) fields of parsed readings."""
    from senslake.operators.filters import required_fields
    return required_fields(readings(spark, sf_dir), ["recorded_at", "device_id", "metric"])


@query("agg9_point_counts", sql=with_(DEVICES, WEV, W_POINTS) + """
SELECT data_type, count(*) AS points FROM w_points GROUP BY 1
""")
def agg9_point_counts(spark, sf_dir):
    """Data points per data type in the raw pulls."""
    return points(spark, sf_dir).groupBy("data_type").agg(F.count("*").alias("points"))


@query("agg18_last_successful_pull", sql=_BOTH + """
, bad AS (SELECT ingest_id FROM w_readings WHERE error IS NOT NULL UNION ALL SELECT ingest_id FROM a_raw WHERE broken)
SELECT device_type, device_id, max(pulled_at) AS last_success FROM raw WHERE ingest_id NOT IN (SELECT ingest_id FROM bad) GROUP BY 1, 2
""")
def agg18_last_successful_pull(spark, sf_dir):
    """Each pull is one run; the resume point is the latest successful one."""
    raw = model.pulls(spark, sf_dir)
    rows = PARSERS["wearable"](raw.where("device_type = 'wearable'"))["readings"]
    unread = payloads.payload_errors(raw, "ingest_id")
    bad = rows.where(F.col("error").isNotNull()).select("ingest_id").unionByName(unread.select("ingest_id")).distinct()
    runs = (raw.join(bad.withColumn("_bad", F.lit(True)), "ingest_id", "left")
            .select("device_type", "device_id", F.col("pulled_at").alias("started_at"),
                    F.when(F.col("_bad"), "failed").otherwise("success").alias("status")))
    return L.last_successful_pull(runs)


_TYPES = ["steps", "active-minutes", "heart-rate", "respiratory-rate-sleep-summary",
          "active-zone-minutes", "exercise", "calories-in-heart-rate-zone", "daily-oxygen-saturation",
          "daily-heart-rate-variability", "daily-heart-rate-zones", "activity-level", "sleep",
          "sedentary-period", "weight"]
_SHAPES = """SELECT p.device_id, p.ingest_id, p.data_type,
       CASE WHEN p.data_type IN ('heart-rate', 'respiratory-rate-sleep-summary', 'weight') THEN 'sample'
            WHEN p.data_type IN ('daily-oxygen-saturation', 'daily-heart-rate-variability',
                                 'daily-heart-rate-zones') THEN 'date'
            WHEN p.data_type = 'calories-in-heart-rate-zone' THEN 'civil'
            WHEN p.data_type = 'mystery-metric' THEN 'unknown' ELSE 'interval' END AS shape,
       CASE WHEN p.data_type IN ('daily-oxygen-saturation', 'daily-heart-rate-variability',
                                 'daily-heart-rate-zones', 'calories-in-heart-rate-zone')
            THEN CASE WHEN p.data_type = 'daily-oxygen-saturation' AND w.event_id % 997 = 0 THEN NULL
                      ELSE CAST(CAST(w.ts AS DATE) AS TIMESTAMP) END
            WHEN p.data_type = 'mystery-metric' THEN NULL ELSE w.ts END AS t_norm
FROM w_points p JOIN wev w ON p.ingest_id = w.event_id
"""


@query("scl7_time_shape", sql=with_(DEVICES, WEV, W_POINTS) + f"""
SELECT ingest_id, data_type, shape, t_norm FROM ({_SHAPES})
""")
def scl7_time_shape(spark, sf_dir):
    """Normalise the time of any point shape: sample string, interval string,
    {year,month,day} date, civil {date:{..}}; unknown shapes -> null."""
    return N.normalised_time(points(spark, sf_dir), _TYPES).select("ingest_id", "data_type", "shape", "t_norm")


@query("agg5_earliest_per_type", sql=with_(DEVICES, WEV, W_POINTS, AEV) + f"""
SELECT device_id, data_type, min(t_norm) AS earliest, count(*) AS points, count(*) - count(t_norm) AS unparsed
FROM ({_SHAPES}) GROUP BY 1, 2
UNION ALL
SELECT device_id, 'air', min(ts), count(*), 0 FROM arec GROUP BY 1
""")
def agg5_earliest_per_type(spark, sf_dir):
    """Earliest normalised time per (device, data type) over every point, sleep, exercise and unmapped types included, and per
    air sensor over every record; null when none parses, and how many do not."""
    p = N.normalised_time(points(spark, sf_dir), _TYPES).select("device_id", "data_type", "t_norm")
    a = air.project(payloads.air_records(model.air_raw(spark, sf_dir)))
    rows = p.unionByName(a.select("device_id", F.lit("air").alias("data_type"), F.col("recorded_at").alias("t_norm")))
    return rows.groupBy("device_id", "data_type").agg(
        F.min("t_norm").alias("earliest"), F.count("*").alias("points"),
        (F.count("*") - F.count("t_norm")).alias("unparsed"))


# A first load of the pulls before Jan 16, then the pulls of that one day: which days each table has, and which the second load rewrote.
_DAYS_SQL = _BOTH + """
, loads AS (SELECT *, CASE WHEN pulled_at < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS n FROM raw WHERE pulled_at < TIMESTAMP '2024-01-17')
, bad AS (
  SELECT DISTINCT l.n, l.device_type, l.device_id FROM loads l
  JOIN (SELECT ingest_id FROM w_readings WHERE error IS NOT NULL UNION ALL SELECT ingest_id FROM a_raw WHERE broken) USING (ingest_id))
, rows_ AS (
  SELECT 'readings' AS table_name, ingest_id, recorded_at, struct_pack(device_id, data_type, recorded_at, metric, tag)::VARCHAR AS k FROM w_readings
  UNION ALL SELECT 'air_readings', ingest_id, ts, struct_pack(device_id, ts)::VARCHAR FROM arec WHERE ingest_id % 41 <> 0)
, ok AS (
  SELECT r.*, l.n FROM rows_ r JOIN loads l USING (ingest_id)
  WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.n = l.n AND b.device_type = l.device_type AND b.device_id = l.device_id))
SELECT table_name, CAST(recorded_at AS DATE) AS day, count(DISTINCT k) AS rows, bool_or(n = 2) AS rewritten FROM ok GROUP BY 1, 2
"""


@query("snk2_touched_days", sql=_DAYS_SQL)
def snk2_touched_days(spark, sf_dir):
    """A one-day pull merged into day-partitioned tables: rows per day, and whether the day's files were rewritten."""
    raw = model.pulls(spark, sf_dir)
    cut, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-16", "2024-01-17"))
    out = []
    listed = {}
    for part in (F.col("pulled_at") < cut, (F.col("pulled_at") >= cut) & (F.col("pulled_at") < end)):
        batch = L.load_batch(raw.where(part))
        for name in ("readings", "air_readings"):
            path, files = listed.setdefault(name, (_folder(spark, f"days-{name}"), []))
            merge_days(batch[name], path, L.TABLES[name])
            table = read_days(spark, path, placed(batch[name], L.TABLES[name]).schema)
            files.append(materialize(spark, table.select("day", F.col("_metadata.file_path").alias("file")).distinct(), "files"))
            if len(files) == 2:
                new = files[1].join(files[0], ["day", "file"], "left_anti").select("day").distinct()
                rows = table.groupBy("day").agg(F.count("*").alias("rows"))
                out.append(rows.join(new.withColumn("new", F.lit(True)), "day", "left").select(
                    F.lit(name).alias("table_name"), "day", "rows", F.coalesce("new", F.lit(False)).alias("rewritten")))
    return reduce(DataFrame.unionByName, out)

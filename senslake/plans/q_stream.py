"""Registered queries: streaming ingest replayed over derived raw pulls.

The raw pulls built from ``events`` are landed as files in the session's
shared checkpoint folder (``spark.checkpoint.dir``), as many as tasks write, and
drained with an ``availableNow`` stream; the query returns the merge-on-read
tables. Failure isolation is per device per batch, so the
landing fixes the batches: one phase is one micro-batch, and the SQL computes
each phase's failed devices by themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from senslake.plans import model
from senslake.plans.q_load import _TABLE
from senslake.plans.registry import query, rounded
from senslake.plans.sql_common import A_RAW, AEV, DEVICES, READINGS_COLS, W_ITEMS, W_RAW, W_READINGS, WEV, with_
from senslake.session import checkpoint_dir, write_split
from senslake.sinks import load as L
from senslake.streaming import coverage as cover
from senslake.streaming import ingest, state


def _drain(spark, parts):
    """Land each part of the pulls and drain it with an availableNow run on one checkpoint: a micro-batch a part."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    for i, part in enumerate(parts):
        write_split(part, f"{base}/landing/phase={i}")
        ingest.start(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt").awaitTermination()
        yield f"{base}/out", i


def _replay(spark, sf_dir, phases: int = 1):
    """With ``phases=2`` the first half of the month lands and is ingested
    first, then the rest: two micro-batches with reproducible contents."""
    raw = model.pulls(spark, sf_dir)
    # Some pulls land twice: the current view keeps one version per key.
    landed = raw.unionByName(raw.where(F.col("ingest_id") % 101 == 0))
    day = F.dayofmonth("pulled_at")
    parts = [landed] if phases == 1 else [landed.where(day <= 15), landed.where(day > 15)]
    return [out for out, _ in _drain(spark, parts)][-1]


def _phases(split: str, more: str = "") -> str:
    """Pulls, readings, air records and failed devices of each micro-batch; ``more``: pulls that come again."""
    return with_(DEVICES, WEV, W_ITEMS, W_READINGS, W_RAW, AEV, A_RAW) + f"""
, first_time AS (
  SELECT *, CAST({split} AS BIGINT) AS batch_id
  FROM (SELECT ingest_id, device_type, device_id, pulled_at FROM w_raw UNION ALL SELECT ingest_id, device_type, device_id, pulled_at FROM a_raw))
, pulls AS (SELECT * FROM first_time {more})
, parsed AS (SELECT r.*, p.pulled_at, p.batch_id FROM w_readings r JOIN pulls p USING (ingest_id))
, failed AS (
  SELECT DISTINCT batch_id, 'wearable' AS device_type, device_id FROM parsed WHERE error IS NOT NULL
  UNION ALL SELECT DISTINCT p.batch_id, 'air', p.device_id FROM pulls p JOIN a_raw a USING (ingest_id) WHERE a.broken)
, loaded AS (SELECT * FROM parsed p WHERE NOT EXISTS (
    SELECT 1 FROM failed f WHERE f.device_type = 'wearable' AND f.batch_id = p.batch_id AND f.device_id = p.device_id))
, air_loaded AS (
  SELECT r.device_id, r.ts AS recorded_at, r.pm25, r.ingest_id, r.pulled_at, r.point_pos, p.batch_id FROM arec r JOIN pulls p USING (ingest_id)
  WHERE NOT EXISTS (SELECT 1 FROM failed f WHERE f.device_type = 'air' AND f.batch_id = p.batch_id AND f.device_id = r.device_id))
, runs AS (
  SELECT p.batch_id, p.device_type, p.device_id, CASE WHEN any_value(f.device_id) IS NULL THEN 'success' ELSE 'failed' END AS status,
         max(p.pulled_at) AS pulled_to
  FROM pulls p LEFT JOIN failed f ON f.batch_id = p.batch_id AND f.device_type = p.device_type AND f.device_id = p.device_id GROUP BY 1, 2, 3)
"""


_TWO = _phases("CASE WHEN day(pulled_at) <= 15 THEN 0 ELSE 1 END")


@query("str1_available_now_ingest", sql=_phases("0") + f"""
SELECT {READINGS_COLS.replace(', error', '')} FROM loaded
QUALIFY row_number() OVER (PARTITION BY device_id, data_type, recorded_at, metric, tag ORDER BY pulled_at DESC) = 1
""")
def str1_available_now_ingest(spark, sf_dir):
    """Landed pulls drained by an availableNow stream -> current readings."""
    return rounded(ingest.current(spark, _replay(spark, sf_dir), "readings").select(*_TABLE))


@query("str1_air_ingest", sql=_phases("0") + """
SELECT device_id, recorded_at, ingest_id, round(pm25, 6) AS pm25 FROM air_loaded
QUALIFY row_number() OVER (PARTITION BY device_id, recorded_at ORDER BY pulled_at DESC, point_pos DESC) = 1
""")
def str1_air_ingest(spark, sf_dir):
    """Landed pulls drained by an availableNow stream -> current air readings."""
    return rounded(ingest.current(spark, _replay(spark, sf_dir), "air_readings").select("device_id", "recorded_at", "ingest_id", "pm25"))


@query("str2_repull_upsert", sql=_TWO + """
SELECT 'readings' AS table_name, device_id, data_type, recorded_at, metric, tag, count(DISTINCT batch_id) AS versions, max(batch_id) AS last_batch
FROM loaded GROUP BY ALL
UNION ALL
SELECT 'air_readings', device_id, NULL, recorded_at, NULL, NULL, count(DISTINCT batch_id), max(batch_id) FROM air_loaded GROUP BY ALL
""")
def str2_repull_upsert(spark, sf_dir):
    """Pulls arriving in two phases (two micro-batches) with a repeated pull:
    keys written in both batches keep their latest version."""
    out = _replay(spark, sf_dir, phases=2)
    keys = ["device_id", "data_type", "recorded_at", "metric", "tag"]
    r = spark.read.parquet(f"{out}/readings").select(F.lit("readings").alias("table_name"), *keys, "batch_id")
    a = spark.read.parquet(f"{out}/air_readings").select(F.lit("air_readings").alias("table_name"), "device_id", "recorded_at", "batch_id")
    return r.unionByName(a, allowMissingColumns=True).groupBy("table_name", *keys).agg(
        F.count("*").alias("versions"), F.max("batch_id").cast("long").alias("last_batch"))


@query("str3_resume_point", sql=_TWO + """
SELECT device_type, device_id, max(batch_id) AS last_batch FROM runs WHERE status = 'success' GROUP BY 1, 2
""")
def str3_resume_point(spark, sf_dir):
    """Resume point per device from the streamed run log: the batch of its latest successful run."""
    out = _replay(spark, sf_dir, phases=2)
    last = ingest.last_success(spark, out).withColumnRenamed("last_success", "started_at")
    log = spark.read.parquet(f"{out}/run_log").where(F.col("status") == "success")
    return last.join(log, ["device_type", "device_id", "started_at"]).select(
        "device_type", "device_id", F.col("batch_id").cast("long").alias("last_batch"))


@query("str4_batch_isolation", sql=_TWO + """
SELECT batch_id, device_type, status, count(*) AS devices FROM runs GROUP BY 1, 2, 3
""")
def str4_batch_isolation(spark, sf_dir):
    """Per micro-batch run log: failed devices of a batch load nothing from
    that batch, other batches are unaffected."""
    log = spark.read.parquet(f"{_replay(spark, sf_dir, phases=2)}/run_log")
    return log.groupBy(F.col("batch_id").cast("long").alias("batch_id"), "device_type", "status").agg(F.count("*").alias("devices"))


# The first half of the month lands without some early pulls; they come late, with the second half and pulls that come again.
_LATE = "day(pulled_at) > 15 OR (device_id % 5 = 0 AND day(pulled_at) <= 5)"
_AGAIN = "UNION ALL SELECT ingest_id, device_type, device_id, pulled_at, 1 FROM first_time WHERE batch_id = 0 AND ingest_id % 7 = 0"
_DELAYED = _phases(f"CASE WHEN {_LATE} THEN 1 ELSE 0 END", _AGAIN)


def _delayed(spark, sf_dir):
    raw = model.pulls(spark, sf_dir)
    late = F.expr(_LATE)
    return [raw.where(~late), raw.where(late | (F.col("ingest_id") % 7 == 0))]


@query("str2_keyed_state", sql=_DELAYED + """
SELECT 'readings' AS table_name, device_id, data_type, recorded_at, metric, tag, ingest_id, round(value_numeric, 6) AS value FROM loaded
QUALIFY row_number() OVER (PARTITION BY device_id, data_type, recorded_at, metric, tag ORDER BY pulled_at DESC) = 1
UNION ALL
SELECT 'air_readings', device_id, 'air', recorded_at, 'pm25', NULL, ingest_id, round(pm25, 6) FROM (SELECT * FROM air_loaded
QUALIFY row_number() OVER (PARTITION BY device_id, recorded_at ORDER BY pulled_at DESC, point_pos DESC) = 1)
""")
def str2_keyed_state(spark, sf_dir):
    """Late and repeated pulls through keyed state: the current tables of both device types, kept batch by batch and read as they are."""
    for out, _ in _drain(spark, _delayed(spark, sf_dir)):
        for table in ("readings", "air_readings"):
            state.keep_current(spark, out, table, f"{out}/state/{table}").awaitTermination()
    r = state.current(spark, out, "readings").select(
        F.lit("readings").alias("table_name"), "device_id", "data_type", "recorded_at", "metric", "tag", "ingest_id", F.col("value_numeric").alias("value"))
    a = state.current(spark, out, "air_readings").select(
        F.lit("air_readings").alias("table_name"), "device_id", F.lit("air").alias("data_type"), "recorded_at", F.lit("pm25").alias("metric"),
        F.lit(None).cast("string").alias("tag"), "ingest_id", F.col("pm25").alias("value"))
    return rounded(r.unionByName(a))


@query("str3_resume_state", sql=_DELAYED + """
, resume AS (SELECT device_type, device_id, max(pulled_to) AS pulled_to FROM runs WHERE status = 'success' AND batch_id = 0 GROUP BY 1, 2)
, moved AS (SELECT device_type, device_id, max(pulled_to) AS pulled_to FROM runs WHERE status = 'success' GROUP BY 1, 2)
SELECT p.device_type, p.device_id, any_value(r.pulled_to) AS first_resume, any_value(m.pulled_to) AS last_resume,
       count(*) FILTER (WHERE r.pulled_to IS NULL OR p.pulled_at > r.pulled_to) AS pending
FROM first_time p LEFT JOIN resume r USING (device_type, device_id) LEFT JOIN moved m USING (device_type, device_id) GROUP BY 1, 2
""")
def str3_resume_state(spark, sf_dir):
    """Resume points kept by keyed state: after the first batch (and how many pulls an incremental pull from there takes), and after the second."""
    parts = _delayed(spark, sf_dir)
    points = []
    for out, _ in _drain(spark, parts):
        state.keep_resume(spark, out, f"{out}/state/resume").awaitTermination()
        points.append(state.resume_points(spark, out))
    pulls = parts[0].unionByName(parts[1]).select("ingest_id", "device_type", "device_id", "pulled_at").distinct()
    keys = ["device_type", "device_id"]
    due = L.since_last_success(pulls, points[0]).groupBy(*keys).agg(F.count("*").alias("pending"))
    out = pulls.select(*keys).distinct()
    for name, p in zip(("first_resume", "last_resume"), points):
        out = out.join(p.withColumnRenamed("pulled_to", name), keys, "left")
    return out.join(due, keys, "left").fillna(0, ["pending"])


@query("str1_event_time_coverage", sql=_DELAYED + """
, rows_ AS (SELECT 'wearable' AS device_type, device_id, recorded_at AS t, batch_id
            FROM (SELECT DISTINCT batch_id, device_id, data_type, recorded_at, metric, tag FROM loaded)
            UNION ALL SELECT 'air', device_id, recorded_at, batch_id FROM (SELECT DISTINCT batch_id, device_id, recorded_at FROM air_loaded))
, dealt AS (
  SELECT *, date_trunc('day', t) AS start,
         batch_id = 1 AND date_trunc('day', t) + INTERVAL 1 DAY <= (SELECT max(t) FROM rows_ WHERE batch_id = 0) - INTERVAL 2 DAY AS late FROM rows_)
SELECT device_type, device_id, start, count(*) FILTER (WHERE NOT late) AS readings, count(*) FILTER (WHERE late) AS late FROM dealt GROUP BY 1, 2, 3
""")
def str1_event_time_coverage(spark, sf_dir):
    """Daily counts by event time on the stream: windows close two days behind the latest time; what comes later is counted apart."""
    for out, _ in _drain(spark, _delayed(spark, sf_dir)):
        for name, device_type in (("readings", "wearable"), ("air_readings", "air")):
            log = spark.readStream.schema(spark.read.parquet(f"{out}/{name}").schema).parquet(f"{out}/{name}")
            one = log.select(F.lit(device_type).alias("device_type"), "device_id", F.col("recorded_at").alias("at"))
            both = one if name == "readings" else both.unionByName(one)
        cover.start_dealing(both, f"{out}/cover", f"{out}/state/deal").awaitTermination()
        cover.start_counting(spark, f"{out}/cover", f"{out}/state/count").awaitTermination()
    return cover.coverage(spark, f"{out}/cover").drop("closed")

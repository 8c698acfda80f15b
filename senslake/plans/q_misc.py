"""Registered queries: raw scans, exports, set/sort helpers, catalog get."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from senslake.operators import stats
from senslake.plans import model, q_stats  # noqa: F401 (its SQL is registered first)
from senslake.plans.registry import ORACLE_SQL, query, rounded
from senslake.plans.sql_common import (AEV, ANALYSIS_LONG, CSV_ROWS, DEVICES, HOURLY_LONG, HOURLY_ROWS,
                                       READINGS, with_)
from senslake.session import checkpoint_dir
from senslake.sinks.load import write_json
from senslake.sources import payloads


@query("src9_raw_scan", sql=with_(DEVICES, AEV) + """
SELECT device_id, count(DISTINCT event_id // 64) AS ingests, max(ts) + INTERVAL 1 HOUR AS last_pull
FROM aev WHERE event_id // 64 IN (
  SELECT event_id // 64 FROM aev a2 WHERE a2.device_id = aev.device_id
  GROUP BY event_id // 64 HAVING max(ts) + INTERVAL 1 HOUR >= TIMESTAMP '2024-01-15')
GROUP BY device_id
""")
def src9_raw_scan(spark, sf_dir):
    """Raw ingests of one device type pulled since a time, from a landed table whose other partitions are not read."""
    air = model.air_raw(spark, sf_dir)
    raw = air.unionByName(model.wearable_raw(spark, sf_dir).select(*air.columns))
    path = f"{checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    payloads.land_raw(raw, path)
    r = payloads.raw_by_device(payloads.read_raw(spark, path), device_type="air", since="2024-01-15")
    return r.groupBy("device_id").agg(F.count("*").alias("ingests"), F.max("pulled_at").alias("last_pull"))


@query("snk5_json_export", sql=ORACLE_SQL["agg2_global_range"])
def snk5_json_export(spark, sf_dir):
    """A result written as JSON lines to the shared folder and read back."""
    g = stats.global_range(model.analysis_long(spark, sf_dir))
    path = f"{checkpoint_dir(spark).rstrip('/')}/json-{uuid.uuid4().hex}"
    write_json(g, path)
    return rounded(spark.read.schema(g.schema).json(path))


@query("set4_set_difference", sql=with_(DEVICES) + """
SELECT device_id FROM devices EXCEPT SELECT user_id FROM events
""")
def set4_set_difference(spark, sf_dir):
    """Registered devices minus devices that delivered data."""
    d = model.devices(spark, sf_dir).select("device_id")
    got = model.readings(spark, sf_dir).select("device_id")
    return d.subtract(got)


@query("srt3_first_and_latest", sql=with_(READINGS) + """
SELECT device_id, min(recorded_at) AS first_ts, round(arg_min(value, (recorded_at, event_id)), 6) AS first_value,
       max(recorded_at) AS last_ts, round(arg_max(value, (recorded_at, event_id)), 6) AS last_value
FROM readings GROUP BY 1
""")
def srt3_first_and_latest(spark, sf_dir):
    """First sample and latest reading per device (min_by / max_by instead
    of sort + limit 1 per device)."""
    r = model.readings(spark, sf_dir)
    o = F.struct("recorded_at", "event_id")
    return rounded(r.groupBy("device_id").agg(
        F.min("recorded_at").alias("first_ts"), F.min_by("value", o).alias("first_value"),
        F.max("recorded_at").alias("last_ts"), F.max_by("value", o).alias("last_value")))


@query("srt4_ordered_report", sql=with_(ANALYSIS_LONG) + """
SELECT df, "column", count(value) AS n, round(min(value), 6) AS min, round(max(value), 6) AS max
FROM analysis_long GROUP BY 1, 2 ORDER BY df, "column"
""")
def srt4_ordered_report(spark, sf_dir):
    """A report in stable output order (sorted by table, column)."""
    g = stats.global_range(model.analysis_long(spark, sf_dir), keys=("df", "column"))
    return rounded(g.select("df", "column", "n", "min", "max").orderBy("df", "column"))


@query("scl8_safe_json_parse", sql=with_(DEVICES, AEV) + """
SELECT k % 50 <> 0 AS parsed, count(*) AS rows FROM aev GROUP BY 1
""")
def scl8_safe_json_parse(spark, sf_dir):
    """Blobs that parse vs blobs that fall back to empty (never an error)."""
    e = model.legacy_export(spark, sf_dir)
    ok = F.try_parse_json(F.trim("data")).isNotNull()
    return e.groupBy(ok.alias("parsed")).agg(F.count("*").alias("rows"))


@query("scl12_coverage_pct", sql=with_(HOURLY_ROWS) + """
, hours AS (SELECT CAST(user_id AS VARCHAR) AS device_id, count(DISTINCT date_trunc('hour', ts)) AS present
            FROM events GROUP BY 1)
SELECT device_id, rows, rows - present AS missing_n,
       round(CASE WHEN rows > 0 THEN (1.0 - (rows - present) / rows) * 100.0 ELSE 0.0 END, 6) AS coverage_pct
FROM hourly_rows JOIN hours USING (device_id)
""")
def scl12_coverage_pct(spark, sf_dir):
    """Coverage % of each device's hourly timeline (any reading in the hour)."""
    r = model.readings(spark, sf_dir)
    present = r.groupBy(F.col("device_id").cast("string").alias("device_id")).agg(
        F.count_distinct(F.date_trunc("hour", "recorded_at")).alias("present"))
    rows = model.hourly_spine_size(spark, sf_dir).select("device_id", "rows")
    j = rows.join(present, "device_id")
    missing = F.col("rows") - F.col("present")
    return rounded(j.select("device_id", "rows", missing.alias("missing_n"),
                            stats.coverage_pct(missing, F.col("rows")).alias("coverage_pct")))


@query("scl16_string_ops", sql=with_(DEVICES, AEV, CSV_ROWS) + """
SELECT CASE WHEN k % 19 = 0 THEN '' WHEN k % 3 = 0 THEN 'yes' WHEN k % 3 = 1 THEN 'cd' ELSE 'no' END AS token,
       count(*) AS rows
FROM csv_named GROUP BY 1
""")
def scl16_string_ops(spark, sf_dir):
    """Trim / lower / split / prefix tests on export cells: charging tokens."""
    from senslake.sources import csv_export as C
    rows = C.split_rows(C.lines_of(model.csv_files(spark, sf_dir)))
    tok = F.lower(F.trim(F.coalesce(C.cell("Charging"), F.lit(""))))
    return rows.groupBy(tok.alias("token")).agg(F.count("*").alias("rows"))


@query("prj34_hierarchical_get", sql=with_(ANALYSIS_LONG) + """
SELECT df, device_id, datetime, "column", round(value, 6) AS value FROM analysis_long
WHERE df IN ('click', 'view') AND "column" = 'value'
""")
def prj34_hierarchical_get(spark, sf_dir):
    """get(tables=['click', 'view'], columns=['value']) over the catalog;
    an unknown table raises, datetime is always kept."""
    from senslake.operators.catalog import get
    return rounded(get(model.analysis_long(spark, sf_dir), tables=["click", "view"], columns=["value"]))

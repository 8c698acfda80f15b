"""Registered report queries: distribution, coverage, overview, rolling."""

from __future__ import annotations

from pyspark.sql import functions as F

from senslake.operators import stats
from senslake.plans import model
from senslake.plans.registry import query, r, rounded
from senslake.plans.sql_common import (ANALYSIS_LONG, HOURLY_LONG, HOURLY_ROWS, with_)


@query("agg2_global_range", sql=with_(ANALYSIS_LONG) + """
SELECT df, device_id, "column", count(value) AS n, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median,
       round(avg(value), 6) AS mean, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max
FROM analysis_long WHERE datetime IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
GROUP BY df, device_id, "column"
""")
def agg2_global_range(spark, sf_dir):
    """Distribution per (table, device, column) of the events analysis frame."""
    return rounded(stats.global_range(model.analysis_long(spark, sf_dir)))


@query("agg1_loss_report", sql=with_(HOURLY_LONG, HOURLY_ROWS) + """
, present AS (SELECT df, device_id, "column", count(*) AS present FROM hourly_long
              WHERE value IS NOT NULL GROUP BY 1, 2, 3)
SELECT 'hourly' AS df, h.device_id, t."column", h.rows, h.rows - coalesce(p.present, 0) AS missing_n,
       round(coalesce(p.present, 0) / h.rows * 100.0, 6) AS coverage_pct
FROM hourly_rows h CROSS JOIN (SELECT DISTINCT event_type AS "column" FROM events) t
LEFT JOIN present p ON p.device_id = h.device_id AND p."column" = t."column"
""")
def agg1_loss_report(spark, sf_dir):
    """Coverage of each event type on each device's hourly timeline."""
    rows = model.hourly_spine_size(spark, sf_dir).select("device_id", "rows")
    out = stats.loss_report(model.hourly_long(spark, sf_dir), rows, keys=("device_id",))
    out = out.withColumn("df", F.lit("hourly"))
    return rounded(out.select("df", "device_id", "column", "rows", "missing_n", "coverage_pct"))


_W10 = "RANGE BETWEEN INTERVAL '863999999999 microseconds' PRECEDING AND CURRENT ROW"


@query("win1_rolling_range", sql=with_(ANALYSIS_LONG) + f"""
SELECT datetime, df, device_id, "column",
       round(min(value) OVER w, 6) AS roll_min, round(max(value) OVER w, 6) AS roll_max,
       round(avg(value) OVER w, 6) AS roll_mean, round(quantile_cont(value, 0.5) OVER w, 6) AS roll_median
FROM analysis_long WHERE datetime IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)
WINDOW w AS (PARTITION BY df, device_id, "column" ORDER BY datetime {_W10})
""")
def win1_rolling_range(spark, sf_dir):
    """10-day rolling band per (table, device, column)."""
    from senslake.operators.rolling import rolling_range
    return rounded(rolling_range(model.analysis_long(spark, sf_dir), "10D"))


def _dense(spark, sf_dir):
    """All devices' values of one event type and column as one series (a hot key)."""
    return model.analysis_long(spark, sf_dir).withColumn("device_id", F.lit("all"))


# The mean is summed in exact decimal arithmetic: on a long series a float
# running sum drifts, and ties at the 7th digit then round differently.
_DENSE_SQL = with_(ANALYSIS_LONG) + f"""
SELECT datetime, df, 'all' AS device_id, "column",
       round(min(value) OVER w, 6) AS roll_min, round(max(value) OVER w, 6) AS roll_max,
       round(avg(CAST(value AS DECIMAL(38, 10))) OVER w, 6) AS roll_mean, round(quantile_cont(value, 0.5) OVER w, 6) AS roll_median
FROM analysis_long WHERE datetime IS NOT NULL AND value IS NOT NULL
WINDOW w AS (PARTITION BY df, "column" ORDER BY datetime {_W10})
"""


@query("win1_rolling_dense_chunked", sql=_DENSE_SQL)
def win1_rolling_dense_chunked(spark, sf_dir):
    """10-day rolling band over one dense series per event type and column (all devices
    pooled), in chunks of two days."""
    from senslake.operators.rolling import rolling_range
    out = rolling_range(_dense(spark, sf_dir), "10D", chunk="2D")
    # 12 digits first: what is half-way in decimals is then half-way in doubles too.
    return rounded(out.withColumn("roll_mean", F.round("roll_mean", 12)))


@query("agg3_table_overview", sql=with_(ANALYSIS_LONG) + """
SELECT df, device_id, count(DISTINCT datetime) AS rows, count(DISTINCT "column") AS columns,
       min(datetime) AS first_ts, max(datetime) AS last_ts
FROM analysis_long GROUP BY df, device_id
""")
def agg3_table_overview(spark, sf_dir):
    """Rows, columns and time range of each table per device."""
    return stats.table_overview(model.analysis_long(spark, sf_dir))


@query("agg4_column_overview", sql=with_(HOURLY_LONG) + """
SELECT df, "column", count(value) AS non_null,
       min(CASE WHEN value IS NOT NULL THEN datetime END) AS first_ts,
       max(CASE WHEN value IS NOT NULL THEN datetime END) AS last_ts
FROM hourly_long GROUP BY df, "column"
""")
def agg4_column_overview(spark, sf_dir):
    """Per column: non-null cells and the time range where it is present."""
    return stats.column_overview(model.hourly_long(spark, sf_dir))


@query("agg11_daily_rolling_mean", sql=with_(ANALYSIS_LONG) + f"""
, roll AS (
  SELECT datetime, df, device_id, "column",
         min(value) OVER w AS roll_min, max(value) OVER w AS roll_max,
         avg(value) OVER w AS roll_mean, quantile_cont(value, 0.5) OVER w AS roll_median
  FROM analysis_long WHERE datetime IS NOT NULL AND value IS NOT NULL
  WINDOW w AS (PARTITION BY df, device_id, "column" ORDER BY datetime {_W10})
), daily AS (
  SELECT df, device_id, "column", CAST(datetime AS DATE) AS day, avg(roll_min) AS roll_min,
         avg(roll_max) AS roll_max, avg(roll_mean) AS roll_mean, avg(roll_median) AS roll_median
  FROM roll GROUP BY 1, 2, 3, 4
), span AS (
  SELECT df, device_id, "column", CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM daily GROUP BY 1, 2, 3
)
SELECT s.df, s.device_id, s."column", s.day, round(d.roll_min, 6) AS roll_min, round(d.roll_max, 6) AS roll_max,
       round(d.roll_mean, 6) AS roll_mean, round(d.roll_median, 6) AS roll_median
FROM span s LEFT JOIN daily d USING (df, device_id, "column", day)
""")
def agg11_daily_rolling_mean(spark, sf_dir):
    """Calendar-day mean of the rolling band; days without data are null rows."""
    from senslake.operators.rolling import rolling_range
    roll = rolling_range(model.analysis_long(spark, sf_dir), "10D")
    out = stats.daily_mean(roll, ["roll_min", "roll_max", "roll_mean", "roll_median"])
    return rounded(out.select("df", "device_id", "column", "day",
                              "roll_min", "roll_max", "roll_mean", "roll_median"))


@query("agg12_rolling_band_summary", sql=with_(ANALYSIS_LONG) + f"""
, roll AS (
  SELECT datetime, df, device_id, "column",
         min(value) OVER w AS roll_min, max(value) OVER w AS roll_max,
         quantile_cont(value, 0.5) OVER w AS roll_median
  FROM analysis_long
  WINDOW w AS (PARTITION BY df, device_id, "column" ORDER BY datetime {_W10})
)
SELECT df, "column", round(quantile_cont(roll_min, 0.5), 6) AS band_min,
       round(quantile_cont(roll_median, 0.5), 6) AS band_center,
       round(quantile_cont(roll_max, 0.5), 6) AS band_max
FROM roll GROUP BY df, "column"
""")
def agg12_rolling_band_summary(spark, sf_dir):
    """Median over time of the rolling min / median / max per table and column."""
    from senslake.operators.rolling import rolling_range
    roll = rolling_range(model.analysis_long(spark, sf_dir), "10D")
    return rounded(stats.rolling_band_summary(roll))


@query("agg13_coverage_band", sql=with_(HOURLY_LONG, HOURLY_ROWS) + """
, present AS (SELECT device_id, "column", count(*) AS present FROM hourly_long GROUP BY 1, 2)
, cov AS (SELECT h.device_id, t."column", coalesce(p.present, 0) / h.rows * 100.0 AS pct
          FROM hourly_rows h CROSS JOIN (SELECT DISTINCT event_type AS "column" FROM events) t
          LEFT JOIN present p ON p.device_id = h.device_id AND p."column" = t."column")
SELECT "column", CASE WHEN pct < 50 THEN '<50' WHEN pct < 80 THEN '<80' ELSE '>=80' END AS band,
       count(*) AS devices
FROM cov GROUP BY 1, 2
""")
def agg13_coverage_band(spark, sf_dir):
    """Devices per coverage band for each event type column."""
    rows = model.hourly_spine_size(spark, sf_dir).select("device_id", "rows")
    rep = stats.loss_report(model.hourly_long(spark, sf_dir), rows, keys=("device_id",))
    return (rep.withColumn("band", stats.coverage_band(F.col("coverage_pct")))
            .groupBy("column", "band").agg(F.count("*").alias("devices")))


@query("agg14_label_split", sql=with_(HOURLY_LONG) + """
, named AS (SELECT CASE WHEN CAST(device_id AS BIGINT) % 4 = 0 THEN "column"
                        ELSE "column" || '_' || device_id END AS merged_column, value FROM hourly_long)
SELECT merged_column AS "column",
       CASE WHEN contains(merged_column, '_') THEN regexp_extract(merged_column, '^(.*)_([^_]*)$', 1)
            ELSE merged_column END AS base_column,
       CASE WHEN contains(merged_column, '_') THEN regexp_extract(merged_column, '^(.*)_([^_]*)$', 2)
            ELSE '' END AS device_label,
       count(*) AS cells
FROM named GROUP BY 1, 2, 3
""")
def agg14_label_split(spark, sf_dir):
    """Split merged-frame column names '<column>_<device>' back into parts.
    Every 4th device is named without suffix (the single-device case)."""
    h = model.hourly_long(spark, sf_dir)
    merged = F.when(F.col("device_id").cast("long") % 4 == 0, F.col("column")) \
        .otherwise(F.concat_ws("_", "column", "device_id"))
    named = h.select(merged.alias("column"), "value")
    return (stats.with_labels(named)
            .groupBy("column", "base_column", "device_label").agg(F.count("*").alias("cells")))


@query("flt1_date_range", sql=with_(ANALYSIS_LONG) + """
SELECT df, device_id, datetime, "column", value FROM analysis_long
WHERE datetime >= TIMESTAMP '2024-01-05 06:00:00' AND datetime <= TIMESTAMP '2024-01-20 00:00:00'
""")
def flt1_date_range(spark, sf_dir):
    """Inclusive [start, end] filter; a date-only end means that midnight."""
    from senslake.operators.filters import date_range
    return date_range(model.analysis_long(spark, sf_dir), "2024-01-05 06:00", "2024-01-20")


@query("flt6_dropna", sql=with_(HOURLY_LONG) + """
, wide AS (
  SELECT device_id, datetime,
         max(CASE WHEN "column" = 'click' THEN value END) AS click,
         max(CASE WHEN "column" = 'error' THEN value END) AS error,
         max(CASE WHEN "column" = 'purchase' THEN value END) AS purchase,
         max(CASE WHEN "column" = 'signup' THEN value END) AS signup,
         max(CASE WHEN "column" = 'view' THEN value END) AS "view"
  FROM hourly_long GROUP BY 1, 2)
SELECT 'any' AS how, count(*) AS rows_kept FROM wide
  WHERE click IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL AND signup IS NOT NULL AND "view" IS NOT NULL
UNION ALL
SELECT 'all', count(*) FROM wide
  WHERE click IS NOT NULL OR error IS NOT NULL OR purchase IS NOT NULL OR signup IS NOT NULL OR "view" IS NOT NULL
UNION ALL
SELECT 'subset', count(*) FROM wide WHERE click IS NOT NULL AND "view" IS NOT NULL
""")
def flt6_dropna(spark, sf_dir):
    """Rows kept by dropna(how='any' / 'all' / subset) on the hourly wide frame."""
    from senslake.operators.filters import drop_nulls
    from senslake.session import materialize
    wide = materialize(spark, model.hourly_wide(spark, sf_dir), "hourly-wide")
    cols = model.EVENT_TYPES
    parts = [drop_nulls(wide, "any", cols).agg(F.count("*").alias("rows_kept"))
             .select(F.lit("any").alias("how"), "rows_kept"),
             drop_nulls(wide, "all", cols).agg(F.count("*").alias("rows_kept"))
             .select(F.lit("all").alias("how"), "rows_kept"),
             drop_nulls(wide, "any", ["click", "view"]).agg(F.count("*").alias("rows_kept"))
             .select(F.lit("subset").alias("how"), "rows_kept")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("jn3_timeline_merge", sql=with_(HOURLY_LONG) + """
SELECT device_id, datetime,
       round(max(CASE WHEN "column" = 'click' THEN value END), 6) AS click,
       round(max(CASE WHEN "column" = 'error' THEN value END), 6) AS error,
       round(max(CASE WHEN "column" = 'purchase' THEN value END), 6) AS purchase,
       round(max(CASE WHEN "column" = 'signup' THEN value END), 6) AS signup,
       round(max(CASE WHEN "column" = 'view' THEN value END), 6) AS "view"
FROM hourly_long GROUP BY 1, 2
""")
def jn3_timeline_merge(spark, sf_dir):
    """Outer merge of each device's five hourly tables on datetime."""
    from senslake.operators.joins import merge_long
    # Dealt by (device, hour) first: the hourly means and the merge share that one exchange.
    e = model.readings(spark, sf_dir).select(F.col("device_id").cast("string").alias("device_id"), F.date_trunc("hour", "recorded_at").cast("timestamp_ntz").alias("datetime"),
                                             F.col("data_type").alias("column"), "value").repartition("device_id", "datetime")
    hourly = e.groupBy("device_id", "datetime", "column").agg(F.avg("value").alias("value"))
    return rounded(merge_long(hourly, model.EVENT_TYPES, keys=("device_id",)))


@query("agg2_bracketed_range", sql=with_(ANALYSIS_LONG) + """
SELECT "column", count(value) AS n, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean,
       round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max
FROM analysis_long WHERE datetime IS NOT NULL AND value IS NOT NULL AND NOT isnan(value) GROUP BY 1
""")
def agg2_bracketed_range(spark, sf_dir):
    """Distribution per column over all tables and devices: two huge groups, their quantiles by bracketing."""
    return rounded(stats.global_range(model.analysis_long(spark, sf_dir), keys=("column",), method="bracket"))


@query("agg1_loss_report_union", sql=with_(HOURLY_LONG) + """
, spine AS (SELECT count(DISTINCT datetime) AS rows FROM hourly_long)
, present AS (SELECT "column" || '_' || device_id AS "column", count(*) AS present FROM hourly_long GROUP BY 1)
SELECT 'merged' AS df, p."column", s.rows, s.rows - p.present AS missing_n,
       round(CASE WHEN s.rows > 0 THEN (1.0 - (s.rows - p.present) / s.rows) * 100.0 ELSE 0.0 END, 6) AS coverage_pct
FROM present p, spine s
""")
def agg1_loss_report_union(spark, sf_dir):
    """Coverage on the merged multi-device frame: every '<type>_<device>'
    column is measured against the union timeline of all devices (an hour
    where only other devices reported counts as missing)."""
    h = model.hourly_long(spark, sf_dir)
    spine = h.agg(F.count_distinct("datetime").alias("rows")).withColumn("df", F.lit("merged"))
    named = h.select(F.lit("merged").alias("df"),
                     F.concat_ws("_", "column", "device_id").alias("column"), "value")
    # The spine is a one-row table: a broadcast cross product of size 1.
    out = stats.loss_report(named, F.broadcast(spine), keys=("df",))
    return rounded(out)

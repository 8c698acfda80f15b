"""Registered queries over overlapping per-device export files."""

from __future__ import annotations

from pyspark.sql import functions as F

from senslake.operators import consolidate as cons
from senslake.plans import model
from senslake.plans.registry import query, rounded
from senslake.plans.sql_common import FILE_CHUNKS, FILE_KEYS, with_
from senslake.session import materialize

_VALUES = ["event_type", "value", "k", "firmware"]
_FILES = with_(FILE_CHUNKS, FILE_KEYS)
_ORDER = "(i.start_date IS NULL, i.start_date, c.file_key)"


@query("src5_device_key", sql=_FILES + """
SELECT file_key, device_id, start_date, end_date FROM file_index
""")
def src5_device_key(spark, sf_dir):
    """Parse '<id>_DD-Mon-YYYY[_DD-Mon-YYYY]' file keys; bad dates skipped."""
    return cons.file_index(model.file_chunks(spark, sf_dir))


@query("set1_concat_chunks", sql=with_(FILE_CHUNKS) + """
SELECT file_key, device_id, datetime, event_type, round(value, 6) AS value, k, firmware FROM file_chunks
""")
def set1_concat_chunks(spark, sf_dir):
    """Union of the file chunks by column name (``firmware`` only in newer files)."""
    return rounded(model.file_chunks(spark, sf_dir).select(
        "file_key", "device_id", "datetime", "event_type", "value", "k", "firmware"))


@query("set2_distinct_rows", sql=with_(FILE_CHUNKS) + """
SELECT DISTINCT device_id, datetime, event_type, round(value, 6) AS value, k, firmware FROM file_chunks
""")
def set2_distinct_rows(spark, sf_dir):
    """Row-level distinct of the concatenated chunks (nulls compare equal)."""
    return rounded(model.file_chunks(spark, sf_dir)
                   .select("device_id", "datetime", *_VALUES).dropDuplicates())


@query("set3_distinct_devices", sql=_FILES + """
SELECT DISTINCT device_id FROM file_index WHERE device_id IS NOT NULL
""")
def set3_distinct_devices(spark, sf_dir):
    """Distinct physical device ids of the export files, sorted."""
    return cons.distinct_devices(cons.file_index(model.file_chunks(spark, sf_dir)))


_CONSOLIDATED = _FILES + f"""
, consolidated AS (
  SELECT c.device_id, c.datetime, c.event_type, c.value, c.k, c.firmware,
         arg_min(c.file_key, {_ORDER}) AS file_key
  FROM file_chunks c LEFT JOIN file_index i ON c.file_key = i.file_key
  GROUP BY c.device_id, c.datetime, c.event_type, c.value, c.k, c.firmware
)"""


@query("set5_consolidate", sql=_CONSOLIDATED + """
SELECT device_id, datetime, event_type, round(value, 6) AS value, k, firmware, file_key FROM consolidated
""")
def set5_consolidate(spark, sf_dir):
    """All files of each physical device merged; identical copies dropped
    (oldest file's copy kept); conflicting copies kept."""
    return rounded(cons.consolidate(model.file_chunks(spark, sf_dir), _VALUES))


@query("set5_overlap_components", sql=with_(FILE_CHUNKS) + """
, files AS (
  SELECT device_id, file_key, count(*) AS rows, min(datetime) AS first_ts, max(datetime) AS last_ts,
         count(DISTINCT date_trunc('second', datetime)) = count(*) AS distinct_times
  FROM split_chunks GROUP BY ALL),
swept AS (
  SELECT *, coalesce(first_ts > max(last_ts) OVER (PARTITION BY device_id ORDER BY first_ts, last_ts, file_key
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens FROM files),
numbered AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY device_id ORDER BY first_ts, last_ts, file_key) AS component FROM swept)
SELECT device_id, file_key, rows, first_ts, last_ts, distinct_times, CAST(component AS BIGINT) AS component,
       count(*) OVER (PARTITION BY device_id, component) = 1 AS alone FROM numbered
""".replace("FROM split_chunks", "FROM (SELECT * REPLACE (CASE WHEN CAST(device_id AS BIGINT) % 3 = 0 THEN file_key ELSE device_id || '_' || strftime(datetime, '%d-%b-%Y') END AS file_key) FROM file_chunks)"))
def set5_overlap_components(spark, sf_dir):
    """Time range of each file and its component of overlapping files; two thirds of the devices export a file a day."""
    found = cons.overlap_components(cons.file_ranges(daily_files(spark, sf_dir)))
    return found.select("device_id", "file_key", "rows", "first_ts", "last_ts", "distinct_times", "component", "alone")


def daily_files(spark, sf_dir):
    """The file chunks, those of two thirds of the devices cut into one file a day, landed."""
    chunks = model.file_chunks(spark, sf_dir)
    day = F.concat("device_id", F.lit("_"), F.date_format("datetime", "dd-MMM-yyyy"))
    return materialize(spark, chunks.withColumn("file_key", F.when(F.col("device_id").cast("long") % 3 == 0, F.col("file_key")).otherwise(day)), "daily-files")


@query("set5_disjoint_files", sql=with_(FILE_CHUNKS) + """
, daily AS (SELECT * REPLACE (CASE WHEN CAST(device_id AS BIGINT) % 3 = 0 THEN file_key
                                   ELSE device_id || '_' || strftime(datetime, '%d-%b-%Y') END AS file_key) FROM file_chunks),
dated AS (SELECT *, try_strptime(split_part(file_key, '_', 2), '%d-%b-%Y') AS d1, try_strptime(nullif(split_part(file_key, '_', 3), ''), '%d-%b-%Y') AS d2 FROM daily)
SELECT device_id, datetime, event_type, round(value, 6) AS value, k, firmware,
       arg_min(file_key, (coalesce(d1, d2) IS NULL, coalesce(d1, d2), file_key)) AS file_key
FROM dated GROUP BY device_id, datetime, event_type, value, k, firmware
""")
def set5_disjoint_files(spark, sf_dir):
    """The consolidated rows where most files are disjoint: those pass without a shuffle."""
    return rounded(cons.consolidate_overlaps(daily_files(spark, sf_dir), _VALUES))


@query("srt1_stable_time_order", sql=_CONSOLIDATED + """
SELECT device_id, datetime, event_type, round(value, 6) AS value, k, firmware, file_key FROM consolidated
ORDER BY device_id, datetime, event_type, value, k, firmware, file_key
""")
def srt1_stable_time_order(spark, sf_dir):
    """Consolidated rows in time order with an explicit, total tie-breaker
    (a range-partitioned global sort: hot devices split across tasks)."""
    out = cons.consolidate(model.file_chunks(spark, sf_dir), _VALUES)
    return rounded(out.orderBy("device_id", "datetime", *_VALUES, "file_key"))


@query("srt2_files_oldest_first", sql=_FILES + """
SELECT file_key, device_id, start_date, end_date,
       row_number() OVER (PARTITION BY device_id ORDER BY start_date ASC NULLS LAST, file_key) AS file_order
FROM file_index
""")
def srt2_files_oldest_first(spark, sf_dir):
    """Files of each device ordered by start date, unknown start last."""
    return cons.files_oldest_first(cons.file_index(model.file_chunks(spark, sf_dir)))


@query("win2_keep_first", sql=_FILES + f"""
SELECT c.device_id, c.datetime, c.event_type, c.firmware, count(*) AS copies,
       arg_min(c.file_key, {_ORDER}) AS kept_file
FROM file_chunks c LEFT JOIN file_index i ON c.file_key = i.file_key
GROUP BY c.device_id, c.datetime, c.event_type, c.value, c.k, c.firmware
HAVING count(*) > 1
""")
def win2_keep_first(spark, sf_dir):
    """For every exactly duplicated row: how many copies, and which file's copy is kept."""
    chunks = model.file_chunks(spark, sf_dir)
    kept = cons.keep_first(chunks, cons.file_index(chunks), ["device_id", "datetime", *_VALUES])
    return kept.where(F.col("copies") > 1).select("device_id", "datetime", "event_type", "firmware", "copies",
                                                  F.col("file_key").alias("kept_file"))


@query("win5_latest_file", sql=_FILES + """
SELECT device_id, arg_max(file_key, (end_date, file_key)) AS latest_file, max(end_date) AS end_date
FROM file_index WHERE end_date IS NOT NULL GROUP BY device_id
""")
def win5_latest_file(spark, sf_dir):
    """Per device, the file with the greatest end date."""
    return cons.latest_file(cons.file_index(model.file_chunks(spark, sf_dir)))


@query("agg6_duplicate_timestamps", sql=with_(FILE_CHUNKS) + """
SELECT device_id, count(*) AS rows, count(DISTINCT datetime) AS distinct_ts,
       count(*) - count(DISTINCT datetime) AS conflicts
FROM file_chunks GROUP BY device_id
""")
def agg6_duplicate_timestamps(spark, sf_dir):
    """Rows minus distinct timestamps per device, before any dedup."""
    return cons.residual_conflicts(model.file_chunks(spark, sf_dir), ["device_id"], "datetime")


@query("agg7_duplicate_classes", sql=_FILES + f"""
SELECT c.device_id, c.datetime,
       arg_min(c.event_type, {_ORDER}) AS event_type,
       round(arg_min(c.value, {_ORDER}), 6) AS value,
       arg_min(c.k, {_ORDER}) AS k, arg_min({{'f': c.firmware}}, {_ORDER}).f AS firmware,
       count(*) AS copies, count(DISTINCT (c.event_type, c.value, c.k, c.firmware)) AS variants,
       CASE WHEN count(*) = 1 THEN 'unique'
            WHEN count(DISTINCT (c.event_type, c.value, c.k, c.firmware)) = 1 THEN 'identical'
            ELSE 'conflict' END AS status
FROM file_chunks c LEFT JOIN file_index i ON c.file_key = i.file_key
GROUP BY c.device_id, c.datetime
""")
def agg7_duplicate_classes(spark, sf_dir):
    """Per timestamp: unique / identical copies / conflict; first file's copy kept."""
    chunks = model.file_chunks(spark, sf_dir)
    idx = cons.file_index(chunks)
    rows = chunks.join(idx.select("file_key", "start_date"), "file_key", "left")
    order = [F.col("start_date").isNull(), F.col("start_date"), F.col("file_key")]
    out = cons.classify_duplicates(rows, ["device_id"], "datetime", _VALUES, order)
    return rounded(out.select("device_id", "datetime", *_VALUES, "copies", "variants", "status"))


@query("agg8_residual_conflicts", sql=_CONSOLIDATED + """
SELECT device_id, count(*) AS rows, count(DISTINCT datetime) AS distinct_ts,
       count(*) - count(DISTINCT datetime) AS conflicts
FROM consolidated GROUP BY device_id
""")
def agg8_residual_conflicts(spark, sf_dir):
    """Timestamps still repeated after dropping identical copies (true conflicts)."""
    out = cons.consolidate(model.file_chunks(spark, sf_dir), _VALUES)
    return cons.residual_conflicts(out, ["device_id"], "datetime")

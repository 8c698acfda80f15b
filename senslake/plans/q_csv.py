"""Registered queries: loose CSV export backfill."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from senslake.functions.text import normalize_mac
from senslake.operators import consolidate as cons
from senslake.operators import stats
from senslake.plans import model
from senslake.plans.registry import query, rounded
from senslake.plans.sql_common import AEV, CSV_FIELDS, CSV_ROWS, DEVICES, with_
from senslake.registry import CSV_ALWAYS_NULL
from senslake.session import checkpoint_dir, materialize
from senslake.sinks.files import write_archives
from senslake.sources import csv_export as C
from senslake.sources import exports as E

_C = with_(DEVICES, AEV, CSV_ROWS)
_FIELDS = ["aqs", "pm1", "pm25", "pm10", "temperature", "humidity", "pressure", "voc_index", "voc",
           "nox_index", "co2", "latitude", "longitude", "altitude", "position_error", "battery"]


def lines(spark, sf_dir):
    # Headers, data rows and file metadata all read the lines: land them once.
    return materialize(spark, C.lines_of(model.csv_files(spark, sf_dir)), "csv-lines")


def landed(spark, sf_dir):
    """A new shared folder that holds the export files, in archives: a device has a file for every 256 events, so they are about as many as the rows."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/exports-{uuid.uuid4().hex}"
    write_archives(model.csv_files(spark, sf_dir), f"{path}/files")
    return path


def records(spark, sf_dir):
    return C.to_records(C.split_rows(lines(spark, sf_dir)))


@query("src4_file_metadata", sql=_C + """
SELECT DISTINCT file_name, CASE WHEN device_id % 9 <> 0 THEN replace(mac, ':', '') END AS mac,
       CASE WHEN device_id % 9 <> 0 THEN 'matched' ELSE 'unmatched' END AS status
FROM csv_named
""")
def src4_file_metadata(spark, sf_dir):
    """MAC from '<12 hex>_*.csv' file names; other names reported unmatched."""
    return C.file_metadata(model.csv_files(spark, sf_dir).select("file_name"))


_RECORDS = _C + """
SELECT file_name, recorded_at, aqs, round(pm1, 6) AS pm1, round(pm25, 6) AS pm25, latitude, longitude
FROM csv_recs
"""


@query("src3_export_source", sql=_RECORDS)
def src3_export_source(spark, sf_dir):
    """The export files through the data source: byte ranges of files, each line with its own file's header, no join."""
    r = C.to_records(E.rows(E.scan(spark, f"{landed(spark, sf_dir)}/files")))
    return rounded(r.select("file_name", "recorded_at", "aqs", "pm1", "pm25", "latitude", "longitude"))


@query("src3_export_stream", sql=_RECORDS)
def src3_export_stream(spark, sf_dir):
    """The export files drained by a stream of the data source into stored lines, then typed."""
    path = landed(spark, sf_dir)
    (E.stream(spark, f"{path}/files", f"{path}/log").writeStream.format("parquet").option("path", f"{path}/lines")
     .option("checkpointLocation", f"{path}/ckpt").trigger(once=True).start().awaitTermination())
    r = C.to_records(E.rows(spark.read.schema(E.SCHEMA).parquet(f"{path}/lines")))
    return rounded(r.select("file_name", "recorded_at", "aqs", "pm1", "pm25", "latitude", "longitude"))


@query("src3_csv_records", sql=_RECORDS)
def src3_csv_records(spark, sf_dir):
    """Every data line of every export: BOM stripped, header by name, split
    on the first n-1 commas, short rows padded, blank lines skipped."""
    r = records(spark, sf_dir)
    return rounded(r.select("file_name", "recorded_at", "aqs", "pm1", "pm25", "latitude", "longitude"))


@query("prj22_csv_header_map", sql=_C + f"SELECT file_name, recorded_at, {CSV_FIELDS} FROM csv_recs")
def prj22_csv_header_map(spark, sf_dir):
    """16 CSV columns mapped by header name (column order differs per file)."""
    return rounded(records(spark, sf_dir).select("file_name", "recorded_at", *_FIELDS))


@query("prj23_date_column", sql=_C + """
SELECT DISTINCT file_name, 'Date (UTC+05:30)' AS date_header, 1 AS date_idx, 330 AS offset_min FROM csv_named
""")
def prj23_date_column(spark, sf_dir):
    """Per file: the first header starting 'Date (UTC', its position and offset."""
    h = C.headers(lines(spark, sf_dir))
    return h.select("file_name", F.element_at("header", F.col("date_idx").cast("int")).alias("date_header"),
                    "date_idx", "offset_min")


@query("prj23_date_any_column", sql=_C + """
SELECT file_name, 2 AS date_idx, recorded_at, aqs FROM csv_recs
""")
def prj23_date_any_column(spark, sf_dir):
    """The same exports with the first two columns swapped: the date is found in the second."""
    line = F.regexp_replace(C._strip_bom(F.col("line")), r"^([^,\r\n]*),([^,\r\n]*)", "$2,$1")
    rows = C.split_rows(lines(spark, sf_dir).withColumn("line", line))
    return C.to_records(rows, keep=("date_idx",)).select("file_name", F.col("date_idx").cast("int").alias("date_idx"), "recorded_at", "aqs")


@query("src3_rejected_files", sql=_C + """
SELECT DISTINCT file_name, 'no date header' AS reason FROM csv_named WHERE md5(file_name) < '8'
""")
def src3_rejected_files(spark, sf_dir):
    """Exports that lost their header (here: those whose name has a small digest) are reported, not silently skipped."""
    headless = (F.md5(F.col("file_name").cast("binary")) < "8") & C.is_header(C._strip_bom(F.col("line")))
    return C.rejected_files(lines(spark, sf_dir).where(~headless))


@query("prj24_charging_tristate", sql=_C + """
SELECT charging, recently_charged, motion, count(*) AS rows FROM csv_recs GROUP BY 1, 2, 3
""")
def prj24_charging_tristate(spark, sf_dir):
    """'yes' -> charging, 'cd' -> recently charged, else neither; motion = 'yes'."""
    return records(spark, sf_dir).groupBy("charging", "recently_charged", "motion") \
        .agg(F.count("*").alias("rows"))


@query("prj25_numeric_coercion", sql=_C + """
SELECT file_name, count(*) AS rows, count(*) - count(pm10) AS pm10_null,
       count(*) - count(temperature) AS temperature_null, count(*) - count(humidity) AS humidity_null
FROM csv_recs GROUP BY 1
""")
def prj25_numeric_coercion(spark, sf_dir):
    """Blank, 'nan' and text cells become nulls, per file."""
    r = records(spark, sf_dir)
    nulls = lambda c: (F.count("*") - F.count(c)).alias(f"{c}_null")
    return r.groupBy("file_name").agg(F.count("*").alias("rows"), nulls("pm10"),
                                      nulls("temperature"), nulls("humidity"))


@query("prj26_null_filled", sql=_C + f"""
SELECT field, rows, rows AS nulls FROM (SELECT unnest({CSV_ALWAYS_NULL}) AS field), (SELECT count(*) AS rows FROM csv_recs)
""")
def prj26_null_filled(spark, sf_dir):
    """The eleven fields that the export never has are columns of every record, and null."""
    return stats.null_profile(records(spark, sf_dir), CSV_ALWAYS_NULL)


@query("scl3_fixed_offset", sql=_C + "SELECT file_name, recorded_at FROM csv_recs")
def scl3_fixed_offset(spark, sf_dir):
    """Local +05:30 export times shifted to UTC by the header's offset."""
    return records(spark, sf_dir).select("file_name", "recorded_at")


@query("src3_backfill_dedup", sql=_C + f"""
, known AS (
  SELECT r.*, d.device_id AS resolved FROM csv_recs r
  JOIN devices d ON replace(d.mac, ':', '') = split_part(r.file_name, '_', 1)
  WHERE r.device_id % 9 <> 0)
SELECT resolved AS device_id, recorded_at, count(*) AS copies,
       count(DISTINCT ({', '.join(f'round({c}, 6)' if c in ('pm1','pm25','pm10','temperature','humidity','pressure','voc') else c for c in _FIELDS)}, charging, recently_charged, motion)) AS variants,
       round(arg_min(pm25, (strptime(split_part(file_name, '_', 2), '%d-%b-%Y'), file_name)), 6) AS pm25,
       CASE WHEN count(*) = 1 THEN 'unique'
            WHEN count(DISTINCT ({', '.join(_FIELDS)}, charging, recently_charged, motion)) = 1 THEN 'identical'
            ELSE 'conflict' END AS status
FROM known GROUP BY 1, 2
""")
def src3_backfill_dedup(spark, sf_dir):
    """Backfill per device: files mapped to devices by MAC, records grouped
    by timestamp -- identical re-exports collapse, differing ones are
    flagged as conflicts and the oldest file's first copy is kept."""
    mac_map = model.devices(spark, sf_dir).select(normalize_mac(F.col("mac")).alias("mac"), "device_id")
    b = E.backfill(E.scan(spark, f"{landed(spark, sf_dir)}/files"), mac_map).where(F.col("device_id").isNotNull())
    vals = [*_FIELDS, "charging", "recently_charged", "motion"]
    out = cons.classify_duplicates(b, ["device_id"], "recorded_at", vals, [C.file_start(F.col("file_name")), F.col("file_name"), F.col("position")])
    return rounded(out.select("device_id", "recorded_at", "copies", "variants", "pm25", "status"))

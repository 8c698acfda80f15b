"""Scans of landed JSON payloads (SRC1, SRC2, SRC8, SRC9).

A raw ingest row is ``(ingest_id, device_type, device_id, ingest_method,
pulled_at, payload string)``. Payloads are parsed once into VARIANT, so
schema drift (new or unknown data types) never fails the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from senslake.operators.joins import maybe_broadcast

RAW_SCHEMA = T.StructType([
    T.StructField("ingest_id", T.LongType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("device_id", T.LongType()),
    T.StructField("ingest_method", T.StringType()),
    T.StructField("pulled_at", T.TimestampNTZType()),
    T.StructField("payload", T.StringType()),
])


def land_raw(raw: DataFrame, path: str) -> None:
    """Land raw ingests for pruned scans: a partition per (device type, pull day), rows range-sorted by device inside,
    so that row groups cover few devices, with a Parquet bloom filter on the device. Appends."""
    keys = ["device_type", "pulled_day", "device_id", "pulled_at"]
    (raw.withColumn("pulled_day", F.to_date("pulled_at")).repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode("append").partitionBy("device_type", "pulled_day")
     .option("parquet.bloom.filter.enabled#device_id", "true").parquet(path))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw ingests landed by :func:`land_raw`."""
    return spark.read.schema(T.StructType([*RAW_SCHEMA.fields, T.StructField("timezone", T.StringType()),
                                           T.StructField("pulled_day", T.DateType())])).parquet(path)


def raw_by_device(raw: DataFrame, device_type=None, device_ids=None,
                  since=None) -> DataFrame:
    """SRC9: raw ingests filtered by type / device / pull time. On a landed
    table the type and the day prune partitions, the devices row groups
    (their range and bloom filter). ``device_ids`` may be a DataFrame
    (device_type, device_id): a semi-join, broadcast under the size limit,
    that prunes the types it lacks at run time."""
    cond = F.lit(True)
    if device_type is not None:
        cond = cond & (F.col("device_type") == device_type)
    if device_ids is not None and not isinstance(device_ids, DataFrame):
        cond = cond & F.col("device_id").isin(list(device_ids))
    if since is not None:
        since = F.lit(str(since)).cast("timestamp_ntz")
        cond = cond & (F.col("pulled_at") >= since)
        if "pulled_day" in raw.columns:
            cond = cond & (F.col("pulled_day") >= F.to_date(since))
    out = raw.where(cond)
    if isinstance(device_ids, DataFrame):
        out = out.join(maybe_broadcast(device_ids.select("device_type", "device_id").distinct()), ["device_type", "device_id"], "left_semi")
    return out


def wearable_sections(raw: DataFrame) -> DataFrame:
    """Payload -> one row per top-level key: (..., data_type, section variant)."""
    keep = [c for c in raw.columns if c != "payload"]
    return raw.select(*keep, F.explode(F.from_json("payload", "map<string,variant>"))
                      .alias("data_type", "section"))


def wearable_points(raw: DataFrame, profile: bool = False) -> DataFrame:
    """SRC1: one row per data point: (..., data_type, point_pos, point).

    ``dataPoints`` is used when non-empty, else ``rollupDataPoints``; a null
    section or two empty lists yield no rows. ``profile`` is not a data type
    and is skipped here (see :func:`wearable_profile`); with ``profile`` its
    section comes as one point, so that one parse serves both.
    """
    s = wearable_sections(raw)
    s = s if profile else s.where(F.col("data_type") != "profile")
    dp = F.try_variant_get("section", "$.dataPoints", "array<variant>")
    rp = F.try_variant_get("section", "$.rollupDataPoints", "array<variant>")
    pts = F.when(F.size(dp) > 0, dp).otherwise(rp)
    if profile:
        there = F.col("section").isNotNull() & ~F.is_variant_null("section")
        pts = F.when(F.col("data_type") != "profile", pts).otherwise(F.when(there, F.array("section")))
    keep = [c for c in s.columns if c != "section"]
    return s.select(*keep, F.posexplode(pts).alias("point_pos", "point"))


def wearable_profile(raw: DataFrame) -> DataFrame:
    """The ``profile`` section of each payload (null / absent -> no row)."""
    s = wearable_sections(raw).where(F.col("data_type") == "profile")
    return s.where(F.col("section").isNotNull() & ~F.is_variant_null("section"))


AIR_RECORD = ("date:string,lat:double,lon:double,aqs:int,pm05_num:int,pm1_num:int,"
              "pm10_num:int,pm25_num:int,voc_index:int,nox_index:int,co2:int,battery:int,altitude:int,"
              "position_error:int,satellites_fixed:int,satellites_in_view:int,pm1:double,pm25:double,"
              "pm10:double,pm_size:double,t:double,h:double,p:double,voc:double,charging:boolean,"
              "recently_charged:boolean,motion:boolean")
_AIR_FIELDS = [tuple(f.split(":")) for f in AIR_RECORD.split(",")]
# Every field is read as the text that the payload holds, so that no spelling of a number is lost in parsing.
_AIR_TEXT = "struct<mac:string,merged_data:array<struct<" + ",".join(f"{n}:string" for n, _ in _AIR_FIELDS) + ">>>"


def _typed(text: Column, typ: str) -> Column:
    """Text of a JSON value as ``typ``: whole numbers may be written 85, 85.0 or "85" (others round); null if it does not cast."""
    if typ == "int":
        return F.round(text.try_cast("double")).try_cast("int")
    return text.try_cast(typ)


def air_records(raw: DataFrame) -> DataFrame:
    """SRC2: air-sensor payload -> one row per ``merged_data`` record.

    Fixed schema parse; keys missing in a record become null. The record's
    position in the payload is kept (``point_pos``) as the tie-breaker of
    last-writer-wins upserts. ``bad_fields`` names the fields whose value
    does not cast (null: none).
    """
    keep = [c for c in raw.columns if c != "payload"]
    p = raw.select(*keep, F.from_json("payload", _AIR_TEXT).alias("_p"))
    rec = p.select(*keep, F.col("_p.mac").alias("mac"), F.posexplode("_p.merged_data").alias("point_pos", "_r"))
    text = {n: F.col(f"_r.{n}") for n, _ in _AIR_FIELDS}
    bad = F.concat_ws(",", *[F.when(text[n].isNotNull() & _typed(text[n], t).isNull(), F.lit(n)) for n, t in _AIR_FIELDS if t != "string"])
    return rec.select(*keep, "mac", "point_pos", *[_typed(text[n], t).alias(n) for n, t in _AIR_FIELDS],
                      F.when(bad != "", bad).alias("bad_fields"))


def payload_errors(raw: DataFrame, key: str = "device_id") -> DataFrame:
    """(key, error): pulls whose payload is no JSON object, or whose ``merged_data`` is no list. They give no
    rows, so without this their device would look loaded."""
    # A payload without the name (or an escape that could spell it) has no such key: it is not searched.
    named = F.contains("payload", F.lit("merged_data")) | F.contains("payload", F.lit("\\"))
    merged = F.when(named, F.get_json_object("payload", "$.merged_data"))
    error = (F.when(F.json_object_keys("payload").isNull(), "payload: not a JSON object")
             .when(merged.isNotNull() & ~F.ltrim(merged).startswith("["), "payload: merged_data is not a list"))
    return raw.select(key, error.alias("error")).where(F.col("error").isNotNull())

"""Multi-file consolidation per physical device (SRC5, SET1-3, SET5, SRT1-2,
WIN2, WIN5, AGG6-8).

Legacy exports arrive as overlapping files keyed ``<id>_DD-Mon-YYYY[_DD-Mon-YYYY]``.
Consolidation runs for all devices at once, partitioned by device; there is
no per-device driver loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from senslake.operators.joins import maybe_broadcast
from senslake.session import materialize

def parse_device_key(key: Column) -> tuple[Column, Column, Column]:
    """SRC5: ``id_DD-Mon-YYYY[_DD-Mon-YYYY...]`` -> (id, first date, last date).

    Parts that do not parse as dates are skipped; one parsable date gives
    start == end; a key without the ``id_rest`` shape gives nulls.
    """
    pat = r"^([A-Za-z0-9]+)_(.+)$"
    ok = key.rlike(pat)
    ident = F.when(ok, F.regexp_extract(key, pat, 1))
    parts = F.split(F.regexp_extract(key, pat, 2), "_")
    dates = F.filter(F.transform(parts, lambda p: F.try_to_timestamp(F.trim(p), F.lit("dd-MMM-yyyy"))
                                 .cast("timestamp_ntz")),
                     lambda d: d.isNotNull())
    has = ok & (F.size(dates) > 0)
    return ident, F.when(has, F.element_at(dates, 1)), F.when(has, F.element_at(dates, -1))


def file_index(chunks: DataFrame, key: str = "file_key") -> DataFrame:
    """Distinct file keys with (device_id, start_date, end_date)."""
    ident, start, end = parse_device_key(F.col(key))
    return (chunks.select(key).distinct()
            .select(key, ident.alias("device_id"), start.alias("start_date"), end.alias("end_date")))


def concat_chunks(frames) -> DataFrame:
    """SET1: union by column name; columns missing in a chunk become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_devices(index: DataFrame) -> DataFrame:
    """SET3: distinct device ids, sorted."""
    return index.where(F.col("device_id").isNotNull()).select("device_id").distinct().orderBy("device_id")


def files_oldest_first(index: DataFrame) -> DataFrame:
    """SRT2: per device, files ordered by start date, unknown start last."""
    w = Window.partitionBy("device_id").orderBy(F.asc_nulls_last("start_date"), "file_key")
    return index.withColumn("file_order", F.row_number().over(w))


def latest_file(index: DataFrame) -> DataFrame:
    """WIN5: per device, the file with the greatest end date (files without
    one are ignored; ties go to the greater key)."""
    return (index.where(F.col("end_date").isNotNull())
            .groupBy("device_id")
            .agg(F.max_by("file_key", F.struct("end_date", "file_key")).alias("latest_file"),
                 F.max("end_date").alias("end_date")))


def keep_first(rows: DataFrame, index: DataFrame, value_cols, key: str = "file_key") -> DataFrame:
    """WIN2 + SET2: drop exact duplicates (all value columns equal, nulls
    equal), keeping the copy from the oldest file (unknown start last).
    Rows with the same timestamp but different values all stay. ``copies``
    counts the rows that collapsed.

    One aggregation with map-side combine: ``min_by`` keeps a single
    candidate per group, so a heavily duplicated row costs no memory.
    """
    # The file index has one row per file: a dimension, joined by key.
    ordered = rows.join(index.select(key, "start_date"), key, "left")
    order = F.struct(F.col("start_date").isNull(), F.col("start_date"), F.col(key))
    return (ordered.groupBy(*value_cols)
            .agg(F.min_by(F.col(key), order).alias(key), F.count("*").alias("copies")))


def residual_conflicts(rows: DataFrame, keys, ts: str) -> DataFrame:
    """AGG8 / AGG6: per key, rows, distinct timestamps, and rows - distinct."""
    return (rows.groupBy(*keys)
            .agg(F.count("*").alias("rows"), F.count_distinct(ts).alias("distinct_ts"))
            .withColumn("conflicts", F.col("rows") - F.col("distinct_ts")))


def classify_duplicates(rows: DataFrame, keys, ts: str, value_cols, order_cols) -> DataFrame:
    """AGG7: per (key, timestamp) classify copies as unique / identical /
    conflict; keep the first copy in ``order_cols`` order and flag conflicts.

    ``count_distinct`` over a struct treats nulls as equal values; ``min_by``
    picks the first copy without materialising the group.
    """
    grp = [*keys, ts]
    sig = F.struct(*value_cols)
    out = (rows.groupBy(*grp)
           .agg(F.count("*").alias("copies"), F.count_distinct(sig).alias("variants"),
                F.min_by(sig, F.struct(*order_cols)).alias("_first"))
           .select(*grp, "_first.*", "copies", "variants"))
    status = (F.when(F.col("copies") == 1, "unique")
              .when(F.col("variants") == 1, "identical").otherwise("conflict"))
    return out.withColumn("status", status)


def consolidate(chunks: DataFrame, value_cols, ts: str = "datetime",
                key: str = "file_key") -> DataFrame:
    """SET5: per physical device -- concat files, drop identical copies
    (oldest file wins), order by time. Conflicting copies remain."""
    index = file_index(chunks, key)
    return keep_first(chunks, index, ["device_id", ts, *value_cols], key).drop("copies")


def file_ranges(chunks: DataFrame, ts: str = "datetime", key: str = "file_key", device: str = "device_id") -> DataFrame:
    """Per (device, file) the rows, the time range that they really cover, and ``distinct_times``: whether no two rows
    share a second and none lacks a time, so that the file holds no copies of its own.

    The seconds are counted exactly in bitmaps of 32,768 of them, combined before the shuffle."""
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    part = (chunks.groupBy(device, key, F.bitmap_bucket_number(second).alias("_bucket"))
            .agg(F.count("*").alias("_rows"), F.min(ts).alias("_first"), F.max(ts).alias("_last"),
                 F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(second))).alias("_seconds")))
    return (part.groupBy(device, key)
            .agg(F.sum("_rows").alias("rows"), F.min("_first").alias("first_ts"), F.max("_last").alias("last_ts"),
                 (F.sum("_rows") == F.sum(F.when(F.col("_bucket").isNotNull(), F.col("_seconds")).otherwise(0))).alias("distinct_times")))


def overlap_components(ranges: DataFrame, key: str = "file_key", device: str = "device_id") -> DataFrame:
    """``ranges`` with ``component`` (from 1 in time order per device; 0 for files without any time) and ``alone``: no
    other file of the device shares a time with it.

    A sweep over the files of a device in order of their first time: a file that begins after all earlier ones have
    ended opens a component. Ranges that touch overlap. The rows are files, not readings."""
    by_start = Window.partitionBy(device).orderBy(F.asc_nulls_first("first_ts"), "last_ts", key)
    before = F.max("last_ts").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("first_ts").isNotNull() & (before.isNull() | (F.col("first_ts") > before))
    swept = ranges.withColumn("_opens", opens.cast("int")).withColumn("component", F.sum("_opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    alone = (F.col("component") > 0) & (F.count("*").over(Window.partitionBy(device, "component")) == 1)
    return swept.withColumn("alone", alone).drop("_opens")


def consolidate_overlaps(chunks: DataFrame, value_cols, ts: str = "datetime", key: str = "file_key") -> DataFrame:
    """:func:`consolidate`, with a shuffle only of the rows that can have a copy: those of files that overlap another
    file of their device, or that hold two rows in one second or rows without a time. Every other file passes as it is.

    ``chunks`` is read three times (ranges, rows that pass, rows that do not), so it should be stored files. The files'
    own times decide, not the dates in their names."""
    # landed, so that its true size (a row per file) decides about the broadcast
    found = materialize(chunks.sparkSession, overlap_components(file_ranges(chunks, ts, key), key), "file-ranges")
    files = found.select(F.col("device_id").alias("_device"), F.col(key).alias("_file"), (F.col("alone") & F.col("distinct_times")).alias("_passes"))
    marked = chunks.join(maybe_broadcast(files), F.col("device_id").eqNullSafe(F.col("_device")) & F.col(key).eqNullSafe(F.col("_file")))
    out = ["device_id", ts, *value_cols, key]
    rest = marked.where("NOT _passes").drop("_device", "_file", "_passes")
    return marked.where("_passes").select(*out).unionByName(consolidate(rest, value_cols, ts, key).select(*out))

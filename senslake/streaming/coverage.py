"""STR1: event-time coverage on the stream, with late rows kept aside.

Readings count into windows of their own time. A window closes once the
stream has seen times ``delay`` beyond its end; closed windows are appended
once and for good. A reading that comes for a closed window is not dropped:
it goes to a side table with its batch.

Two steps, both restartable. The first deals each batch of the log into
``ontime`` and ``late`` by the frontier, the latest time of all batches before
it (one stored row a batch). The second is a watermarked ``window()`` count
over ``ontime`` in append mode; its watermark never passes the frontier that
dealt the rows, so it has nothing to drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROWS = "device_type string, device_id long, at timestamp_ntz"


def _bounds(at, window: str):
    w = F.window(at, window)
    return w["start"].cast("timestamp_ntz"), w["end"].cast("timestamp_ntz")


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def deal(out_dir: str, delay: str, window: str):
    """The first step's foreachBatch body; run again, a batch writes the same rows: it looks at earlier batches only."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = [] if batch_id == 0 else (spark.read.schema("at timestamp_ntz, batch_id long").parquet(f"{out_dir}/frontier")
                                         .where(F.col("batch_id") < batch_id).agg(F.max("at")).collect())
        frontier = F.lit(seen[0][0] if seen else None).cast("timestamp_ntz")
        batch = batch.persist()
        try:
            late = F.coalesce(_bounds(F.col("at"), window)[1] <= frontier - F.expr(f"interval {delay}"), F.lit(False))
            _put(batch.where(late), f"{out_dir}/late", batch_id)
            _put(batch.where(~late), f"{out_dir}/ontime", batch_id)
            _put(batch.agg(F.max("at").alias("at")), f"{out_dir}/frontier", batch_id)
        finally:
            batch.unpersist()
    return run


def start_dealing(log: DataFrame, out_dir: str, checkpoint: str, delay: str = "2 days", window: str = "1 day"):
    """``log``: a stream of (device_type, device_id, at). Rows without a time count nowhere and are left out."""
    rows = log.select("device_type", "device_id", "at").where("at is not null")
    return (rows.writeStream.foreachBatch(deal(out_dir, delay, window)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def start_counting(spark: SparkSession, out_dir: str, checkpoint: str, delay: str = "2 days", window: str = "1 day"):
    """Closed windows, appended to ``closed`` as they close."""
    rows = spark.readStream.schema(_ROWS + ", batch_id long").parquet(f"{out_dir}/ontime")
    at = F.col("at").cast("timestamp").alias("at")
    counted = (rows.select("device_type", "device_id", at).withWatermark("at", delay)
               .groupBy(F.window("at", window).alias("w"), "device_type", "device_id").agg(F.count("*").alias("readings")))
    out = counted.select("device_type", "device_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "readings")
    return (out.writeStream.outputMode("append").foreachBatch(lambda df, i: _put(df, f"{out_dir}/closed", i))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def coverage(spark: SparkSession, out_dir: str, window: str = "1 day") -> DataFrame:
    """(device_type, device_id, start, readings, late, closed): closed windows as appended, open ones counted from the rows
    still on their way, and the late rows of each. Every row of the log is in one of the two counts."""
    shape = "device_type string, device_id long, start timestamp_ntz, readings long, batch_id long"
    keys = ["device_type", "device_id", "start"]
    closed = spark.read.schema(shape).parquet(f"{out_dir}/closed").select(*keys, "readings")

    def counted(name: str, as_: str) -> DataFrame:
        rows = spark.read.schema(_ROWS + ", batch_id long").parquet(f"{out_dir}/{name}")
        return rows.groupBy("device_type", "device_id", _bounds(F.col("at"), window)[0].alias("start")).agg(F.count("*").alias(as_))

    open_ = counted("ontime", "readings").join(closed.select(*keys), keys, "left_anti")
    both = closed.withColumn("closed", F.lit(True)).unionByName(open_.withColumn("closed", F.lit(False)))
    out = both.join(counted("late", "late"), keys, "full_outer")
    # A window with nothing but late rows had closed before its first row came.
    return out.fillna(0, ["readings", "late"]).fillna(True, ["closed"])

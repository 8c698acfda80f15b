"""Streaming replay equals the batch load; repeated pulls are deduplicated."""

import uuid

from pyspark.sql import functions as F

from senslake.plans import model
from senslake.sinks import load as L
from senslake.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_available_now_replay_equals_batch(spark, tmp_dir):
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    raw = model.wearable_raw(spark, SF)
    again = raw.where(F.col("ingest_id") % 7 == 0)          # the same pulls landed twice
    raw.unionByName(again).write.parquet(f"{base}/landing")
    q = ingest.start(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    streamed = ingest.current(spark, f"{base}/out", "readings")
    loaded = L.load_wearable_batch(spark, raw)
    batch = loaded["readings"]
    cols = ["device_id", "data_type", "recorded_at", "metric", "tag", "value_numeric", "ingest_id"]
    a = sorted(map(tuple, streamed.select(*cols).collect()), key=str)
    b = sorted(map(tuple, batch.select(*cols).collect()), key=str)
    assert a == b and len(a) > 0
    for df in loaded["cached"]:
        df.unpersist()
    log = spark.read.parquet(f"{base}/out/run_log")
    assert log.select("batch_id").distinct().count() == 1
    assert ingest.last_success(spark, f"{base}/out").count() == \
        log.where("status = 'success'").select("device_id").distinct().count()


def test_late_and_other_pulls_are_kept(spark, tmp_dir):
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    raw = model.wearable_raw(spark, SF).where("device_id % 50 = 1")
    late = raw.select(*[(F.col(c) - F.expr("interval 10 days")).alias(c) if c == "pulled_at" else F.col(c) for c in raw.columns])
    other = raw.limit(3).withColumn("device_type", F.lit("scale"))
    air = model.air_raw(spark, SF).select(*raw.columns)
    air = air.unionByName(air.limit(1).withColumn("device_id", F.lit(-1).cast("long")).withColumn("payload", F.lit("{broken")))
    for i, part in enumerate((raw, late.unionByName(other).unionByName(air))):
        part.write.parquet(f"{base}/landing/phase={i}")
        ingest.start(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt").awaitTermination()
    assert spark.read.parquet(f"{base}/out/unrouted").count() == 3
    log = spark.read.parquet(f"{base}/out/run_log")
    assert log.where("device_type = 'wearable'").groupBy("device_id").count().where("count < 2").count() == 0
    assert [tuple(r) for r in log.where("device_id = -1").select("status", "error_message").collect()] == [("failed", "payload: not a JSON object")]
    stored = ingest.current(spark, f"{base}/out", "air_readings")
    batch = L.load_air_batch(air)["air_readings"]
    assert stored.count() == batch.count() > 0 and stored.exceptAll(batch.select(*stored.columns)).count() == 0
    assert not spark.sparkContext._jsc.getPersistentRDDs() or len(spark.sparkContext._jsc.getPersistentRDDs()) <= 2

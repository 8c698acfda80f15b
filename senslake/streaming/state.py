"""Keyed state over the ingest's logs (STR2, STR3): which version of a key is the latest, how far a device has come.

The ingest appends what each batch loaded (``streaming.ingest``). Two streams
follow that log and keep tables that are read as they are:

  log of a table --transformWithState, key (day, bucket)--> versions newer
    than any seen --foreachBatch--> upsert of the touched partitions
  run log --transformWithState, key device--> resume points that moved
    --foreachBatch--> resume table

State lives in RocksDB and expires ``ttl`` after its last change, so it does
not grow with the history. It only screens: a version that comes back after
its state has expired meets the table's own order columns and loses there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from senslake.sinks import load as L
from senslake.sinks.partitioned import merge_days, read_days

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a key's state outlives its last change.
TTL = dt.timedelta(days=45)
#: Blocks of state per day, by the digest of the natural key: a call of the processor costs about a millisecond, so a block serves
#: thousands of keys, and a device with most of a day's rows is in all of the day's blocks. Fixed for the life of a checkpoint.
BUCKETS = 32
_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
_ENTRY = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("us", "<i8"), ("pos", "<i8")])


def newest(seen: np.ndarray, k1, k2, us, pos) -> tuple[np.ndarray, np.ndarray]:
    """(rows to keep, entries to remember): of the offered versions those that are newer than any seen of their key,
    the greatest (us, pos) of each key. ``seen`` and the result are sorted by key, one entry a key."""
    new = np.zeros(len(k1), _ENTRY)
    for name, col in zip(_ENTRY.names, (k1, k2, us, pos)):
        new[name] = col
    both = np.concatenate([seen, new])
    # Of equal versions the one that was there first comes last, and so wins.
    order = np.lexsort((-np.arange(len(both)), both["pos"], both["us"], both["k2"], both["k1"]))
    key = both[["k1", "k2"]][order]
    last = order[np.append(key[1:] != key[:-1], True)] if len(order) else order
    return last[last >= len(seen)] - len(seen), both[last]


class LatestVersions(StatefulProcessor):
    """Per (day, bucket): the latest version of each natural key, as one sorted block of digests and orders. The rows are taken
    chunk by chunk, so a key may pass several versions on, each newer than the last; the upsert keeps the latest."""

    def __init__(self, ttl: dt.timedelta = TTL):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "entries binary", ttlDurationMs=int(self.ttl.total_seconds() * 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        held = self.seen.get()
        seen = np.frombuffer(held[0], _ENTRY) if held else np.zeros(0, _ENTRY)
        moved = False
        for new in rows:
            keep, seen = newest(seen, *(new[c].to_numpy() for c in ("k1", "k2", "us", "pos")))
            if len(keep):
                moved = True
                yield new.iloc[np.sort(keep)][["row"]]
        if moved:
            self.seen.update((seen.tobytes(),))

    def close(self) -> None:
        pass


class ResumePoint(StatefulProcessor):
    """Per device: the latest pull that a successful run has loaded."""

    def __init__(self, ttl: dt.timedelta | None = None):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        more = {"ttlDurationMs": int(self.ttl.total_seconds() * 1000)} if self.ttl else {}
        self.at = handle.getValueState("at", "us long", **more)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:
        had = self.at.get()
        best = max(int(r["us"].max()) for r in rows)
        if not had or best > had[0]:
            self.at.update((best,))
            yield pd.DataFrame({"device_type": [key[0]], "device_id": [key[1]], "us": [best]})

    def close(self) -> None:
        pass


def _drain(out: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool, interval: str):
    w = out.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    # Expiring state always asks for another batch, so a drain is one batch of all that has landed, not availableNow.
    return (w.trigger(once=True) if available_now else w.trigger(processingTime=interval)).start()


def _log(spark: SparkSession, path: str) -> DataFrame:
    """A table's log as a stream, with the schema that it was written with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def current_path(out_dir: str, table: str) -> str:
    return f"{out_dir}/current/{table}"


def keep_current(spark: SparkSession, out_dir: str, table: str, checkpoint: str, ttl: dt.timedelta = TTL,
                 available_now: bool = True, interval: str = "30 minutes", buckets: int = BUCKETS):
    """STR2: follow the log of ``table`` and keep its current version at ``current/<table>``. Late pulls lose to what is
    newer, repeated ones pass nothing on; a batch that is run again merges the same rows."""
    spec = L.TABLES[table]
    log = _log(spark, f"{out_dir}/{table}")
    cols = [c for c in log.columns if c != "batch_id"]
    schema = log.select(*cols).schema
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\0")) for c in spec.key]
    pulled = F.unix_micros(F.col("pulled_at").cast("timestamp"))
    # The row travels as one text column: what the state needs are two digests of its key and its order.
    flat = log.select(F.coalesce(F.to_date(spec.time).cast("string"), F.lit("none")).alias("day"),
                      F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int").alias("bucket"), F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("k2"), pulled.alias("us"),
                      F.col("point_pos").cast("long").alias("pos"), F.to_json(F.struct(*cols), _TS).alias("row"))
    fresh = flat.groupBy("day", "bucket").transformWithStateInPandas(LatestVersions(ttl), "row string", "Update", "ProcessingTime")

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.from_json("row", schema, _TS).alias("r")).select("r.*")
        merge_days(rows, current_path(out_dir, table), spec)

    return _drain(fresh, sink, checkpoint, available_now, interval)


def current(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """The current table: a plain scan."""
    schema = spark.read.parquet(f"{out_dir}/{table}").drop("batch_id").schema
    return read_days(spark, current_path(out_dir, table), schema).drop("day", "bucket")


_RESUME = L.TableSpec("resume", ("device_type", "device_id"), order=("pulled_to",))


def keep_resume(spark: SparkSession, out_dir: str, checkpoint: str, available_now: bool = True, interval: str = "30 minutes"):
    """STR3: follow the run log and keep each device's resume point (``pulled_to``) at ``resume``."""
    log = _log(spark, f"{out_dir}/run_log").where("status = 'success' and pulled_to is not null and device_id is not null")
    flat = log.select("device_type", "device_id", F.unix_micros(F.col("pulled_to").cast("timestamp")).alias("us"))
    moved = flat.groupBy("device_type", "device_id").transformWithStateInPandas(
        ResumePoint(), "device_type string, device_id long, us long", "Update", "None")

    def sink(batch: DataFrame, batch_id: int) -> None:
        to = F.timestamp_micros("us").cast("timestamp_ntz")
        # One row a device, so each version holds the devices, not the history.
        old = L.read_table(batch.sparkSession, f"{out_dir}/resume")
        rows = batch.select("device_type", "device_id", to.alias("pulled_to"))
        rows = rows if old is None else old.unionByName(rows)
        L.write_table(L.latest_per_key(rows.withColumn("_o", F.col("pulled_to")), _RESUME.key, ["_o"]).drop("_o"), f"{out_dir}/resume", _RESUME)

    return _drain(moved, sink, checkpoint, available_now, interval)


def resume_points(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """(device_type, device_id, pulled_to) of every device that has succeeded; None before the first."""
    return L.read_table(spark, f"{out_dir}/resume")

"""SNK6: the life of a load run, and the load that keeps it.

A run is two appended events per device: ``start`` is committed before
anything is parsed, ``end`` after everything is written. Nothing is updated in
place, so a load that is killed leaves its start events, and its devices read
as ``running``; a load that is run again under its id replaces its own events.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from senslake.session import materialize
from senslake.sinks import load as L

EVENTS = ("device_type string, device_id long, at timestamp_ntz, status string, error_message string, "
          "rows long, duplicates long, run_id string, event string")
TOTALS = "table_name string, rows long, duplicates long, run_id string"


def _append(df: DataFrame, path: str, *by: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def _events(devices: DataFrame, event: str, run_id: str, at: Column | None, **cols) -> DataFrame:
    at = F.current_timestamp().cast("timestamp_ntz") if at is None else at
    values = {"at": at, "run_id": F.lit(run_id), "event": F.lit(event), **cols}
    names = [c.split()[0] for c in EVENTS.split(", ")]
    out = devices.withColumns(values)
    return out.select(*[F.col(n).cast(t) for n, t in (c.split() for c in EVENTS.split(", "))]).toDF(*names)


def start_runs(devices: DataFrame, log: str, run_id: str, at: Column | None = None) -> None:
    """Start events of ``devices`` (device_type, device_id)."""
    none = F.lit(None)
    _append(_events(devices, "start", run_id, at, status=F.lit("running"), error_message=none, rows=none,
                    duplicates=none), f"{log}/events", "run_id", "event")


def end_runs(outcome: DataFrame, log: str, run_id: str, at: Column | None = None) -> None:
    """End events of ``outcome`` (device_type, device_id, status, error_message, rows, duplicates)."""
    _append(_events(outcome, "end", run_id, at), f"{log}/events", "run_id", "event")


def runs(spark: SparkSession, log: str) -> DataFrame:
    """One row per run and device: started_at, ended_at, status (``running`` without an end), error, rows, duplicates."""
    e = spark.read.schema(EVENTS).parquet(f"{log}/events")
    end = F.col("event") == "end"
    last = lambda c: F.max(F.when(end, F.col(c)))  # noqa: E731 - one end event per run and device
    return e.groupBy("run_id", "device_type", "device_id").agg(
        F.min(F.when(F.col("event") == "start", F.col("at"))).alias("started_at"), last("at").alias("ended_at"),
        F.coalesce(last("status"), F.lit("running")).alias("status"), last("error_message").alias("error_message"),
        last("rows").alias("rows"), last("duplicates").alias("duplicates"))


def run_totals(spark: SparkSession, log: str) -> DataFrame:
    """Rows written and duplicates resolved per run and table."""
    return spark.read.schema(TOTALS).parquet(f"{log}/totals")


def tracked_load(raw: DataFrame, log: str, run_id: str, sink: Callable[[str, DataFrame], None],
                 tz: DataFrame | None = None, at: Column | None = None, end_at: Column | None = None) -> dict:
    """Load ``raw`` (pulls of any registered device types) as run ``run_id``: start events, then the tables through
    ``sink(name, rows)``, then end events with each device's rows and duplicates.

    Every table is landed once, with the number of versions that each key had; its totals are observed while it is
    written (no extra pass), the devices' counts are read from it. A device that fails loads nothing and ends as
    ``failed`` with its first error; an exception leaves all devices of the run ``running``. Returns the totals.
    Stages count in the totals alone (their device is that of their session)."""
    spark = raw.sparkSession
    devices = raw.select("device_type", "device_id").distinct()
    start_runs(devices, log, run_id, at)
    batch = L.load_batch(raw, tz, versions="versions")
    totals, counts = {}, []
    for name in L.TABLES:
        seen = Observation(f"{run_id}:{name}")
        rows = batch[name].observe(seen, F.count("*").alias("rows"), F.coalesce(F.sum(F.col("versions") - 1), F.lit(0)).alias("duplicates"))
        rows = materialize(spark, rows, f"run-{name}")
        totals[name] = seen.get
        sink(name, rows.drop("versions"))
        if "device_id" in rows.columns:
            counts.append(rows.groupBy(F.lit(L.TABLES[name].device_type).alias("device_type"), "device_id").agg(
                F.count("*").alias("rows"), F.sum(F.col("versions") - 1).alias("duplicates")))
    per = reduce(DataFrame.unionByName, counts).groupBy("device_type", "device_id").agg(F.sum("rows").alias("rows"), F.sum("duplicates").alias("duplicates"))
    outcome = batch["run_log"].join(per, ["device_type", "device_id"], "left").fillna(0, ["rows", "duplicates"])
    end_runs(outcome, log, run_id, end_at)
    seen = spark.createDataFrame([(n, t["rows"], t["duplicates"], run_id) for n, t in totals.items()], TOTALS)
    _append(seen.coalesce(1), f"{log}/totals", "run_id")
    return totals

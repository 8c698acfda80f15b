"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list; default the headline set below,
'all' for every registered query). Each query is executed to completion
with the ``noop`` sink (no collect to the driver) and timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "agg2_global_range", "agg1_loss_report", "win1_rolling_range", "win1_rolling_dense_chunked",
    "set5_consolidate", "agg7_duplicate_classes", "src1_wearable_points", "prj17_grain_span",
    "snk2_upsert_readings", "snk6_run_log", "prj20_air_project", "src3_backfill_dedup",
    "jn7_reading_participant", "jn3_timeline_merge", "agg11_daily_rolling_mean", "agg2_bracketed_range",
]


def minute_series(spark):
    """The survey's dense target: one device at one-minute cadence for 30 days, a 10-day window, chunks of three days."""
    from pyspark.sql import functions as F
    from senslake.operators.rolling import rolling_range
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).cast("timestamp_ntz")
    rows = spark.range(43_200).select(F.lit("d").alias("device_id"), at.alias("datetime"), (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 100).alias("value"))
    return rolling_range(rows, "10D", keys=["device_id"], chunk="3D")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from senslake.session import get_session
    from senslake.plans.catalog import QUERIES

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    names = os.environ.get("BENCH_QUERIES")
    if names == "all":
        names = list(QUERIES)
    elif names:
        names = [n.strip() for n in names.split(",") if n.strip()]
    else:
        names = HEADLINE
    # Warm-up: JVM, Python workers and file listing, outside the timings.
    QUERIES["agg3_table_overview"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
        # Queries are independent: drop what one persisted before the next.
        spark.catalog.clearCache()
    if names is HEADLINE:
        t0 = time.time()
        minute_series(spark).write.format("noop").mode("overwrite").save()
        times["win1_43200_rows"] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()

"""senslake: multi-device sensor-study analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    scans of landed payloads, CSV exports, study registries, driver tables
functions  reusable Column expressions (time, JSON, text helpers)
operators  DataFrame -> DataFrame operators (normalise, quality, joins, stats, rolling)
sinks      raw-ingest append, key-based upsert, run log, JSON export
streaming  Structured Streaming ingest (foreachBatch upsert, watermark dedup)
plans      the sensor model derived from the driver tables and the registered queries
"""

from senslake.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]

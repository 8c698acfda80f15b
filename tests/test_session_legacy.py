"""Shared checkpoint folder from the session; legacy JSON-blob parsing."""

import json

from pyspark.sql import functions as F

from senslake.operators import legacy as G
from senslake.session import checkpoint_dir, materialize


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == configured
    df = materialize(spark, spark.range(10), "probe")
    assert df.count() == 10
    assert df.inputFiles()[0].startswith("file:" + configured) or configured in df.inputFiles()[0]


def test_json_blob_expand_and_detection(spark):
    rows = [("2026-07-09T15:31:00Z", "d1", json.dumps({"pm": {"pm2_5_atm_ug_m3": 7.5, "pm0_3_um_count": 3},
                                                       "gps": {"lat": 22.5, "lon": 88.3}})),
            ("2026-07-09T15:32:00Z", "d1", "not json"),
            ("2026-07-09T15:33:00Z", "d1", json.dumps({"pm": {"pm2_5_atm_ug_m3": 8.0}}))]
    df = spark.createDataFrame(rows, "timestamp string, device string, data string")
    assert G.detect_json_column(df) == "data"
    std = G.standardize(df)
    assert "datetime" in std.columns and {"latitude", "longitude"} <= set(std.columns)
    t = G.split_tables(std)
    pm = {r.datetime.minute: r for r in t["pm"].collect()}
    assert pm[31].pm2_5_ugm3_atm == 7.5 and pm[32].pm2_5_ugm3_atm is None and pm[33].pm0_3_um_count is None
    assert t["gis"].where(F.col("latitude").isNotNull()).count() == 1

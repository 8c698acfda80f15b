"""Reports and rolling windows against pandas (the reference's engine)."""

import datetime as dt

import numpy as np
import pandas as pd

from senslake.operators import rolling, stats


def _long(spark, ts_vals, device="d"):
    rows = [("t", device, ts, "c", v) for ts, v in ts_vals]
    return spark.createDataFrame(rows, "df string, device_id string, datetime timestamp_ntz, "
                                       "column string, value double")


def test_global_range_matches_pandas(spark):
    rng = np.random.default_rng(1)
    base = dt.datetime(2024, 1, 1)
    vals = [(base + dt.timedelta(minutes=i), float(rng.normal())) for i in range(200)]
    vals.append((base, None))
    out = stats.global_range(_long(spark, vals)).first()
    s = pd.Series([v for _, v in vals if v is not None])
    assert out.n == len(s)
    assert abs(out.q25 - s.quantile(0.25)) < 1e-12 and abs(out.median - s.median()) < 1e-12
    assert abs(out.mean - s.mean()) < 1e-12


def test_rolling_is_equal_for_any_chunk_and_to_pandas_with_ties_D8(spark):
    rng = np.random.default_rng(2)
    base = dt.datetime(2024, 1, 1)
    ts = sorted(base + dt.timedelta(hours=int(h)) for h in rng.integers(0, 24 * 30, 400))
    vals = [(t, float(v)) for t, v in zip(ts, rng.normal(size=len(ts)))]
    df = _long(spark, vals)
    nat = rolling.rolling_range(df, "10D").toPandas()
    chk = rolling.rolling_range(df, "10D", chunk="3D").toPandas()
    key = ["datetime", "roll_min", "roll_max"]
    a = nat.sort_values(key).reset_index(drop=True)
    b = chk.sort_values(key).reset_index(drop=True)
    assert len(a) == len(b) == len(vals)
    for c in ["roll_min", "roll_max", "roll_mean", "roll_median"]:
        assert np.allclose(a[c], b[c], atol=1e-9)
    # Against pandas on the last row of each tie group (RANGE peers).
    s = pd.Series([v for _, v in vals], index=pd.DatetimeIndex([t for t, _ in vals]))
    p = s.rolling("10D", min_periods=1)
    ref = pd.DataFrame({"datetime": s.index, "mx": p.max().to_numpy(), "md": p.median().to_numpy()})
    ref = ref.groupby("datetime").last().reset_index()
    got = a.groupby("datetime").last().reset_index()
    assert np.allclose(ref["mx"], got["roll_max"]) and np.allclose(ref["md"], got["roll_median"])


def test_loss_report_and_band(spark):
    present = spark.createDataFrame([("d", "c", 1.0), ("d", "c", 2.0)], "device_id string, column string, value double")
    rows = spark.createDataFrame([("d", 4)], "device_id string, rows long")
    r = stats.loss_report(present, rows, keys=("device_id",)).first()
    assert (r.rows, r.missing_n, r.coverage_pct) == (4, 2, 50.0)


def test_label_split(spark):
    df = spark.createDataFrame([("pm25_dev1",), ("temp",), ("a_b_c",)], "column string")
    got = {(r.column, r.base_column, r.device_label) for r in stats.with_labels(df).collect()}
    assert got == {("pm25_dev1", "pm25", "dev1"), ("temp", "temp", ""), ("a_b_c", "a_b", "c")}


def test_rolling_of_dense_and_sparse_series_is_equal_for_any_chunk(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=7 * i), float(i % 13)) for i in range(3000)]
    df = _long(spark, rows, device="hot").unionByName(_long(spark, rows[:50], device="cold"))
    auto = rolling.rolling_range(df, "1D", chunk="6h").toPandas()
    nat = rolling.rolling_range(df, "1D", chunk="40D").toPandas()
    key = ["device_id", "datetime"]
    a = auto.sort_values(key).reset_index(drop=True)
    b = nat.sort_values(key).reset_index(drop=True)
    assert len(a) == len(b) == 3050
    for c in ["roll_min", "roll_max", "roll_mean", "roll_median"]:
        assert np.allclose(a[c], b[c])


def test_rolling_keeps_infinities_for_any_chunk(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(hours=i), float("inf") if i == 5 else float(i)) for i in range(40)]
    df = _long(spark, rows)
    one, many = (rolling.rolling_range(df, "10h", chunk=c).orderBy("datetime").toPandas() for c in ("90D", "3h"))
    assert one["roll_max"].tolist() == many["roll_max"].tolist() and np.isinf(one["roll_max"][10]) and one["roll_max"][20] == 20


def test_loss_report_has_a_row_for_a_column_without_values(spark):
    present = spark.createDataFrame([("d", "c", 1.0), ("e", "c", 1.0), ("e", "x", 2.0)], "device_id string, column string, value double")
    rows = spark.createDataFrame([("d", 4), ("e", 2)], "device_id string, rows long")
    got = {(r.device_id, r.column): (r.missing_n, r.coverage_pct) for r in stats.loss_report(present, rows, keys=("device_id",)).collect()}
    assert got == {("d", "c"): (3, 25.0), ("d", "x"): (4, 0.0), ("e", "c"): (1, 50.0), ("e", "x"): (1, 50.0)}


def test_global_range_keeps_null_key_groups(spark):
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 1), 1.0), (None, dt.datetime(2024, 1, 2), 3.0)], "device_id string, datetime timestamp_ntz, value double")
    for method in ("percentile", "bracket"):
        r = stats.global_range(df, keys=("device_id",), method=method).collect()
        assert len(r) == 1 and r[0].n == 2 and r[0].median == 2.0

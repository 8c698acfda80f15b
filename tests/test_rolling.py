"""WIN1 against a plain loop over each window."""

import datetime as dt
import math

import numpy as np
import pytest

from senslake.operators import rolling

T0 = dt.datetime(2024, 1, 1)


def brute(rows, seconds):
    out = []
    for key, t, v in rows:
        if t is None or v is None or math.isnan(v):
            continue
        w = sorted(x for k, u, x in rows if k == key and u is not None and x is not None and not math.isnan(x) and t - dt.timedelta(seconds=seconds) < u <= t)
        with np.errstate(invalid="ignore"):
            out.append((key, t, w[0], w[-1], float(np.mean(np.array(w, np.longdouble))), float(np.median(w))))
    return sorted(out, key=str)


def same(got, want):
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-12, atol=0)


def roll(spark, rows, **more):
    df = spark.createDataFrame([(k, t, v, 1) for k, t, v in rows], "device string, datetime timestamp_ntz, value double, roll_x int")
    return sorted(((r.device, r.datetime, r.roll_min, r.roll_max, r.roll_mean, r.roll_median) for r in rolling.rolling_range(df, keys=["device"], **more).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = [(k, T0 + dt.timedelta(seconds=int(s)), float(v)) for k in ("a", "b", None) for s, v in zip(rng.integers(0, 900, 90), rng.integers(-3, 4, 90) * 0.1)]
    out += [("far", T0 + dt.timedelta(days=400), 1.0), ("far", T0, 1e300), ("far", T0 + dt.timedelta(seconds=30), -1e300), ("far", T0 + dt.timedelta(seconds=100), 0.1)]
    out += [("null", None, 1.0), ("null", T0, None), ("null", T0, math.nan), ("old", dt.datetime(1950, 1, 1, 0, 0, 1), 2.0), ("old", dt.datetime(1950, 1, 1), 1.0)]
    return out + [("tie", T0, float(i)) for i in range(9)]


@pytest.mark.parametrize("chunk", [None, "1s", "17s", "61s", "10D"])
def test_equals_a_loop_whatever_the_chunk(spark, rows, chunk):
    same(roll(spark, rows, window="60s", chunk=chunk), brute(rows, 60))


def test_infinite_and_huge_values_leave_no_trace_in_later_windows(spark):
    rows = [("x", T0 + dt.timedelta(seconds=i), {3: math.inf, 20: -math.inf, 40: 1e300}.get(i, 0.1 * i)) for i in range(60)]
    got, want = roll(spark, rows, window="5s"), brute(rows, 5)
    same(got, want)
    at = {r[1]: r for r in got}
    at = [at[T0 + dt.timedelta(seconds=i)] for i in range(60)]
    assert at[12][4] == pytest.approx(1.0, rel=1e-14) and at[22][4] == -math.inf and at[4][3] == math.inf and at[50][4] == pytest.approx(4.8, rel=1e-14)


def test_blocks_carry_a_series_over_batches(rows):
    import pyarrow as pa
    rng = np.random.default_rng(1)
    us = np.sort(rng.integers(0, 5000, 3000))
    key = np.sort(rng.integers(0, 7, 3000))
    us = np.concatenate([np.sort(us[key == k]) for k in range(7)])
    v = rng.integers(0, 50, 3000).astype(float)
    table = pa.table({"ts": pa.array(us), "k": pa.array(key), "_v": pa.array(v), "_us": pa.array(us), "_home": pa.array(np.zeros(3000, np.int64)), "_chunk": pa.array(np.zeros(3000, np.int64))})
    old, rolling.BLOCK_ROWS = rolling.BLOCK_ROWS, 200
    got = pa.Table.from_batches(list(rolling._roll(100, 1)(iter(table.to_batches(max_chunksize=37)))))
    rolling.BLOCK_ROWS = old
    assert got.num_rows == 3000
    for i in range(0, 3000, 13):
        w = v[(key == key[i]) & (us > us[i] - 100) & (us <= us[i])]
        assert [got.column(c)[i].as_py() for c in rolling.ROLLED] == pytest.approx([w.min(), w.max(), w.mean(), np.median(w)])


def test_order_statistics_of_any_range():
    rng = np.random.default_rng(2)
    v = rng.permutation(777)
    lo = rng.integers(0, 700, 400)
    hi = lo + rng.integers(1, 77, 400)
    k = rng.integers(0, 1 << 30, (3, 400)) % (hi - lo)
    got = rolling.kth(v, lo, hi, k)
    assert all(got[j, i] == np.sort(v[lo[i]:hi[i]])[k[j, i]] for j in range(3) for i in range(400))
    x = rng.normal(size=777)
    assert rolling.window_sums(x, lo, hi).astype(float) == pytest.approx([x[a:b].sum() for a, b in zip(lo, hi)])


def test_no_rows(spark):
    assert roll(spark, [("a", None, 1.0)], window="5s") == []

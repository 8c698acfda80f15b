"""WIN1: time-range rolling min / max / mean / median.

Semantics: for every non-null value at time t, aggregate the values of the
same series with timestamp in ``(t - window, t]``. Rows sharing a timestamp
are peers and all see each other (SQL RANGE semantics), so the result does
not depend on the physical order of ties.

Time is cut into chunks, each row is copied into the chunks whose look-back
it falls in (at most ``ceil(window / chunk) + 1`` copies), rows are shuffled
and sorted by (series, chunk, time), and each task works through its sorted
rows in blocks of whole chunks. Inside a block no window is recomputed: values
are ranked once, a wavelet matrix over the ranks answers every window's order
statistics together, one pass per bit of the rank, and sums come from dyadic
partial sums, so nothing outside a window enters its mean. The work is
O(rows x log rows) whatever the cadence or the window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from senslake.functions.time import duration_us

#: Rows that a block gathers before its complete chunks are worked through.
BLOCK_ROWS = 1 << 17
#: Windows answered at once.
BLOCK_WINDOWS = 1 << 19
ROLLED = ("roll_min", "roll_max", "roll_mean", "roll_median")


def rolling_range(df: DataFrame, window: str = "10D", keys=("df", "device_id", "column"),
                  ts: str = "datetime", value: str = "value", chunk: str | None = None) -> DataFrame:
    """``chunk`` (default: the window) bounds what one task holds of a series:
    one chunk and one window of look-back. The result does not depend on it."""
    keys = list(keys)
    w_us = duration_us(window)
    c_us = duration_us(chunk) if chunk else w_us
    v = F.col(value).cast("double")
    base = df.where(F.col(ts).isNotNull() & v.isNotNull() & ~F.isnan(v))
    t = _us(ts)
    home = F.floor(t / c_us)
    # Chunk c needs row r when c*C - W < t_r, i.e. c <= floor((t_r + W - 1) / C).
    last = F.floor((t + F.lit(w_us - 1)) / c_us)
    copies = base.select(ts, *keys, v.alias("_v"), t.alias("_us"), home.alias("_home"),
                         F.explode(F.sequence(home, last)).alias("_chunk"))
    by = [*keys, "_chunk"]
    schema = df.select(ts, *keys).schema
    for name in ROLLED:
        schema = schema.add(name, DoubleType())
    sorted_ = copies.repartition(*by).sortWithinPartitions(*by, "_us")
    return sorted_.mapInArrow(_roll(w_us, len(keys)), schema)


def _us(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _roll(w_us: int, n_keys: int):
    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < BLOCK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            whole = int(np.flatnonzero(_starts(table, n_keys))[-1])
            if whole:
                yield from _block(table.slice(0, whole), w_us, n_keys)
            held, rows = table.slice(whole).combine_chunks().to_batches(), table.num_rows - whole
        if rows:
            yield from _block(pa.Table.from_batches(held), w_us, n_keys)
    return run


def _starts(table: pa.Table, n_keys: int) -> np.ndarray:
    """True where a (series, chunk) begins; null keys are equal."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for i in [*range(1, n_keys + 1), n_keys + 4]:
        code = table.column(i).combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return new


def _block(table: pa.Table, w_us: int, n_keys: int):
    v, us, home, chunk = (table.column(n_keys + i).to_numpy() for i in range(1, 5))
    start = np.flatnonzero(_starts(table, n_keys))
    sizes = np.diff(np.append(start, len(v)))
    lo, hi = window_bounds(us, np.repeat(start, sizes), np.repeat(start + sizes, sizes), w_us)
    mine = np.flatnonzero(home == chunk)
    out = table.select(range(n_keys + 1))
    for at in range(0, len(mine), BLOCK_WINDOWS):
        rows = mine[at:at + BLOCK_WINDOWS]
        found = window_stats(v, lo[rows], hi[rows])
        part = out.take(pa.array(rows)).combine_chunks()
        for name, col in zip(ROLLED, found):
            part = part.append_column(name, pa.array(col))
        yield from part.to_batches(max_chunksize=10_000)


def window_bounds(us: np.ndarray, start: np.ndarray, end: np.ndarray, w_us: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows [lo, hi) of each row's window (t - w, t], inside its own run [start, end) of rows sorted by time."""
    # One increasing axis for all runs: each run begins more than a window after the one before.
    run = np.cumsum(start != np.concatenate([[-1], start[:-1]])) - 1 if len(us) else start
    first = us[start]
    span = us[end - 1] - first + w_us + 1
    shift = np.concatenate([[0], np.cumsum(span[np.flatnonzero(np.diff(run))])]) if len(us) else np.zeros(1, np.int64)
    axis = us - first + shift[run]
    return np.searchsorted(axis, axis - w_us, "right"), np.searchsorted(axis, axis, "right")


def window_stats(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[np.ndarray]:
    """Min, max, mean and median of ``v[lo:hi]`` for every (non-empty) window."""
    order = np.argsort(v, kind="stable")
    rank = np.empty(len(v), np.int64)
    rank[order] = np.arange(len(v))
    n = hi - lo
    least, greatest, left, right = v[order][kth(rank, lo, hi, np.stack([np.zeros_like(n), n - 1, (n - 1) // 2, n // 2]))]
    with np.errstate(invalid="ignore", over="ignore"):
        mean = (window_sums(v, lo, hi) / n).astype(np.float64)
        median = np.where(left == right, left, left * 0.5 + right * 0.5)
    return [least, greatest, mean, median]


def kth(rank: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The ``k``-th smallest (from 0) of ``rank[lo:hi]`` for rows of ``k``; ``rank`` is a permutation.

    A wavelet matrix, built and asked level by level: each level keeps the ranks whose bit is 0 before those whose bit
    is 1, in order, and a window stays a range in each half."""
    lo, hi = np.broadcast_to(lo, k.shape), np.broadcast_to(hi, k.shape)
    out = np.zeros(k.shape, np.int64)
    for b in reversed(range(max(1, (len(rank) - 1).bit_length()))):
        bit = (rank >> b) & 1
        zeros = np.concatenate([[0], np.cumsum(1 - bit)])
        zl, zh = zeros[lo], zeros[hi]
        up = k >= zh - zl
        k = np.where(up, k - (zh - zl), k)
        out |= up.astype(np.int64) << b
        lo, hi = np.where(up, zeros[-1] + lo - zl, zl), np.where(up, zeros[-1] + hi - zh, zh)
        rank = np.concatenate([rank[bit == 0], rank[bit == 1]])
    return out


def window_sums(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sum of ``v[lo:hi]`` from dyadic blocks that lie inside it, in extended precision: values elsewhere, infinite or huge, leave no trace."""
    level, lo, hi = v.astype(np.longdouble), lo.copy(), hi.copy()
    total = np.zeros(len(lo), np.longdouble)
    while True:
        at = np.flatnonzero((lo < hi) & (lo & 1 == 1))
        total[at] += level[lo[at]]
        lo[at] += 1
        at = np.flatnonzero((lo < hi) & (hi & 1 == 1))
        hi[at] -= 1
        total[at] += level[hi[at]]
        if not (lo < hi).any():
            return total
        lo, hi = lo >> 1, hi >> 1
        if len(level) & 1:
            level = np.append(level, 0)
        level = level[::2] + level[1::2]

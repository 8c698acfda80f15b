"""Joins of the study model (JN1-11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many bytes a dimension is not broadcast; the planner's shuffle
# join (and AQE's runtime conversion) handles it instead.
BROADCAST_LIMIT = 64 * 1024 * 1024
#: Rows of an exploded table that is broadcast at most: the planner's estimate ignores what ``explode`` makes of a row.
BROADCAST_ROWS = 200_000


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when the optimizer's size estimate is within
    ``limit``; otherwise return it unchanged for a shuffle join."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        size = int(size.toString())
    except Exception:  # noqa: BLE001 - estimate unavailable: do not broadcast
        return df
    return F.broadcast(df) if size <= limit else df


def merge_on_time(tables: dict, keys=(), ts: str = "datetime", how: str = "outer") -> DataFrame:
    """JN3: merge tables ``{name: df}`` on (keys, ts), which compare null-safe.

    Repeated timestamps multiply as a join does and no row is lost. A value
    column that several tables have gets the table's name as a suffix
    (``temp_inside``, ``temp_outside``). Outer, left and inner merges of any
    number of tables are one exchange: the tables' union is grouped by (keys,
    ts), each table's rows of a group are a list, and the lists' product is
    the result; a list is never longer than the rows it gives. Other merges
    are a left fold of joins.
    """
    on = list(keys) + [ts]
    held = [c for f in tables.values() for c in f.columns if c not in on]
    frames = [f.select(*on, *[F.col(c).alias(f"{c}_{name}" if held.count(c) > 1 else c)
                              for c in f.columns if c not in on])
              for name, f in tables.items()]
    if how not in ("outer", "full", "full_outer", "fullouter", "left", "left_outer", "leftouter", "inner"):
        return reduce(lambda a, b: join_null_safe(a, b, on, how), frames)
    values = [[c for c in f.columns if c not in on] for f in frames]
    rows = [f.select(*on, F.struct(F.lit(True).alias("_"), *v).alias(f"_{i}")) for i, (f, v) in enumerate(zip(frames, values))]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return _product(together.groupBy(*on).agg(*[F.collect_list(f"_{i}").alias(f"_{i}") for i in range(len(rows))]), on, values, how)


def _product(lists: DataFrame, on: list, values: list, how: str) -> DataFrame:
    """One row per combination of the lists ``_0``, ``_1``, ...; an empty list counts as one null row where ``how`` keeps it."""
    for i in range(len(values)):
        kept = how != "inner" and (i > 0 or not how.startswith("left"))
        lists = lists.withColumn(f"_{i}", (F.explode_outer if kept else F.explode)(f"_{i}"))
    return lists.select(*on, *[F.col(f"_{i}.{c}").alias(c) for i, v in enumerate(values) for c in v])


def merge_long(rows: DataFrame, names, keys=(), ts: str = "datetime", column: str = "column", value: str = "value") -> DataFrame:
    """JN3 on a long frame (keys, ts, column, value): the outer merge of its columns ``names`` as tables, from one scan."""
    on = list(keys) + [ts]
    c = F.col(column)
    lists = [F.collect_list(F.when(c == n, F.struct(F.lit(True).alias("_"), F.col(value).alias(n)))).alias(f"_{i}") for i, n in enumerate(names)]
    return _product(rows.where(c.isin(list(names))).groupBy(*on).agg(*lists), on, [[n] for n in names], "outer")


def join_null_safe(a: DataFrame, b: DataFrame, on, how: str) -> DataFrame:
    """Join with null-equal keys; the key columns are coalesced into one."""
    if how == "cross":
        raise ValueError("cross merge is not supported")
    cond = reduce(lambda x, y: x & y, [F.col(f"_a.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in on])
    out = a.alias("_a").join(b.alias("_b"), cond, how)
    if how in ("left_anti", "leftanti", "left_semi", "leftsemi"):
        return out
    keep = [F.coalesce(F.col(f"_a.{k}"), F.col(f"_b.{k}")).alias(k) for k in on]
    rest = [F.col(f"_a.{c}") for c in a.columns if c not in on] + \
           [F.col(f"_b.{c}") for c in b.columns if c not in on]
    return out.select(*keep, *rest)


def interval_join(readings: DataFrame, periods: DataFrame, device: str = "device_id",
                  ts: str = "recorded_at", start: str = "assigned_from",
                  until: str = "assigned_until", how: str = "inner", cell_days: int = 7, limit: int = BROADCAST_ROWS) -> DataFrame:
    """JN7: attach the period(s) valid at each reading: same device and
    ``start <= date(ts) < until`` (null until = open). With ``how='inner'``
    readings outside every period get no row; ``how='left'`` keeps them with
    a null period in the same single join.

    Time is cut into cells of ``cell_days``. A reading lies in one cell, a
    period is copied into the cells it reaches (an open or long one no
    further than the readings do), and the equi-join is on (device, cell) with
    the exact check inside: each pair once, and a device with a third of the
    rows spreads over its cells. The copies are counted: up to ``limit`` they
    are broadcast, more are sorted and merged, which spills.
    """
    d = F.to_date(F.col(ts))
    cell = lambda day: F.floor(F.unix_date(day) / cell_days)
    first, last = readings.agg(F.min(cell(d)), F.max(cell(d))).first()
    end = F.date_sub(F.col(until).cast("date"), 1)
    a = F.greatest(cell(F.col(start).cast("date")), F.lit(first).cast("long"))
    b = F.coalesce(F.least(cell(end), F.lit(last).cast("long")), F.lit(last).cast("long"))
    reach = periods.where(F.col(start).isNotNull()).withColumn("_a", a).withColumn("_b", b).where("_a <= _b")
    copies = reach.agg(F.sum(F.col("_b") - F.col("_a") + 1)).first()[0] or 0
    p = reach.withColumn("_pcell", F.explode(F.sequence("_a", "_b"))).drop("_a", "_b").withColumnRenamed(device, "_pdev")
    cond = ((F.col(device) == F.col("_pdev")) & (F.col("_cell") == F.col("_pcell")) & (d >= F.col(start))
            & (F.col(until).isNull() | (d < F.col(until))))
    return readings.withColumn("_cell", cell(d)).join(p.hint("broadcast" if copies <= limit else "merge"), cond, how).drop("_pdev", "_cell", "_pcell")

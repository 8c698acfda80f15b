"""AGG2: exact quantiles by bracketing, for groups of any size.

``percentile`` keeps every distinct value of a group in one buffer. Here a
mergeable sketch first gives each (group, quantile) a bracket that must hold
the wanted ranks; a second pass counts what lies below the bracket (a partial
sum) and keeps the values inside alone, counted before they are shuffled. A
group of n rows sends about ``4 n / accuracy`` distinct values to a task, and
a value that a third of all rows share is one of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from senslake.operators.joins import join_null_safe, maybe_broadcast

#: Ranks that the sketch gives are off by n / ACCURACY at most.
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, keys, value: str, qs, names, accuracy: int = ACCURACY) -> DataFrame:
    """(keys..., n, min, max, mean, <name per q>) over the non-null, non-NaN values, null keys being a group.

    Interpolation follows ``percentile``: position h = (n - 1) q, between the values at ranks floor(h) and ceil(h).
    The bracket is the sketch's values at q -+ 2 / accuracy, so it holds both ranks with n / accuracy to spare on
    either side; up to 4 * accuracy rows, where that is less than four ranks, it is the group's whole range."""
    keys, v = list(keys), F.col("_v")
    base = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")).where(~F.isnan(v))
    sides = [p for q in qs for p in (max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy))]
    sketch = base.groupBy(*keys).agg(F.count("*").alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
                                     F.percentile_approx(v, F.array(*[F.lit(p) for p in sides]), accuracy).alias("_s"))
    small = F.col("n") <= 4 * accuracy
    brackets = F.array(*[F.struct(F.lit(i).alias("i"), F.when(small, F.col("min")).otherwise(F.col("_s")[2 * i]).alias("lo"),
                                  F.when(small, F.col("max")).otherwise(F.col("_s")[2 * i + 1]).alias("hi")) for i in range(len(qs))])
    groups = sketch.select(*keys, "n", "min", "max", "mean", brackets.alias("_b"))
    rows = join_null_safe(base, maybe_broadcast(groups.select(*keys, "n", "_b")), keys, "inner")
    below = rows.groupBy(*keys).agg(*[F.sum(F.when(v < F.col("_b")[i]["lo"], 1).otherwise(0)).alias(f"_{i}") for i in range(len(qs))])
    inside = rows.select(*keys, "n", "_v", F.explode("_b").alias("b")).where((v >= F.col("b.lo")) & (v <= F.col("b.hi")))
    counted = inside.groupBy(*keys, F.col("b.i").alias("i"), "n", "_v").agg(F.count("*").alias("c"))
    ranked = join_null_safe(counted, maybe_broadcast(below), keys, "inner")
    before = reduce(lambda e, i: e.when(F.col("i") == i, F.col(f"_{i}")), range(1, len(qs)), F.when(F.col("i") == 0, F.col("_0")))
    up_to = F.sum("c").over(Window.partitionBy(*keys, "i").orderBy("_v")) + before
    h = reduce(lambda e, i: e.when(F.col("i") == i, F.lit(float(qs[i]))), range(1, len(qs)), F.when(F.col("i") == 0, F.lit(float(qs[0])))) * (F.col("n") - 1)
    at = ranked.select(*keys, "i", "_v", up_to.alias("u"), h.alias("h"))
    low, high = (F.min(F.when(F.col("u") > r, v)) for r in (F.floor("h"), F.ceil("h")))
    one = at.groupBy(*keys, "i", "h").agg(low.alias("low"), high.alias("high"))
    part = F.col("h") - F.floor("h")
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") * (1 - part) + F.col("high") * part)
    wide = one.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, between)).alias(name) for i, name in enumerate(names)])
    return join_null_safe(groups.drop("_b"), wide, keys, "inner")

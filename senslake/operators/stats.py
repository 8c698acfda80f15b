"""Report statistics over the long analysis frame.

Input shape for most operators: ``(df, device_id, datetime, column, value)``.
Staying long turns the per-table, per-column loops of a notebook into one
group-by with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from senslake.functions.text import label_split


def global_range(long_df: DataFrame, keys=("df", "device_id", "column"),
                 method: str = "percentile") -> DataFrame:
    """AGG2: n, min, q25, median, mean, q75, max of non-null values.

    Rows with a null datetime are dropped first; all-null columns produce no
    row (a group only exists when it has a value); null keys are a group.
    Quantiles are exact with linear interpolation, by one aggregate.
    ``method='bracket'`` is the caller's choice for groups with too many
    distinct values for one buffer: two more passes, and no buffer of a
    group's size (:mod:`senslake.operators.brackets`), with equal results.
    """
    keys = list(keys)
    v = F.col("value")
    clean = long_df.where(F.col("datetime").isNotNull() & v.isNotNull() & ~F.isnan(v))
    if method == "percentile":
        q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        return (clean.groupBy(*keys)
                .agg(F.count(v).alias("n"), F.min(v).alias("min"), q.alias("_q"),
                     F.avg(v).alias("mean"), F.max(v).alias("max"))
                .select(*keys, "n", "min", F.col("_q")[0].alias("q25"),
                        F.col("_q")[1].alias("median"), "mean",
                        F.col("_q")[2].alias("q75"), "max"))
    if method != "bracket":
        raise ValueError(f"unknown method {method!r}")
    from senslake.operators.brackets import exact_quantiles
    out = exact_quantiles(clean, keys, "value", [0.25, 0.5, 0.75], ["q25", "median", "q75"])
    return out.select(*keys, "n", "min", "q25", "median", "mean", "q75", "max")


def loss_report(present_long: DataFrame, table_rows: DataFrame,
                keys=("df", "device_id")) -> DataFrame:
    """AGG1: per table x column -- rows, missing_n, coverage_pct.

    ``present_long`` holds the cells ``(*keys, column, value)``;
    ``table_rows`` holds the row count of each table ``(*keys, rows)``. A
    missing cell is a table row without a value; coverage is 0 for an empty
    table. Every column that any device of a table family (the keys but
    ``device_id``) has is reported for each of its tables: a column without a
    value on a device is 0 % there. The column list is as long as the
    schema is wide.
    """
    keys = list(keys)
    family = [k for k in keys if k != "device_id"]
    known = present_long.select(*family, "column").distinct()
    spine = table_rows.join(known, family) if family else table_rows.crossJoin(F.broadcast(known))
    present = (present_long.where(F.col("value").isNotNull())
               .groupBy(*keys, "column").agg(F.count("*").alias("_present")))
    out = spine.join(present, [*keys, "column"], "left")
    missing = F.col("rows") - F.coalesce(F.col("_present"), F.lit(0))
    return out.select(*keys, "column", "rows", missing.alias("missing_n"),
                      coverage_pct(missing, F.col("rows")).alias("coverage_pct"))


def coverage_pct(missing: Column, rows: Column) -> Column:
    """SCL12: (1 - missing/rows) * 100, 0 when the table is empty."""
    return F.when(rows > 0, (F.lit(1.0) - missing / rows) * 100.0).otherwise(F.lit(0.0))


def coverage_band(pct: Column) -> Column:
    """AGG13: '<50', '<80', else '>=80'."""
    return F.when(pct < 50, "<50").when(pct < 80, "<80").otherwise(">=80")


def table_overview(long_df: DataFrame, keys=("df", "device_id")) -> DataFrame:
    """AGG3: rows and time range per table per device."""
    return (long_df.groupBy(*keys)
            .agg(F.countDistinct("datetime").alias("rows"),
                 F.countDistinct("column").alias("columns"),
                 F.min("datetime").alias("first_ts"),
                 F.max("datetime").alias("last_ts")))


def column_overview(long_df: DataFrame, keys=("df", "column")) -> DataFrame:
    """AGG4: where each column is present -- non-null rows and time range."""
    present = F.col("value").isNotNull()
    return (long_df.groupBy(*keys)
            .agg(F.count(F.when(present, 1)).alias("non_null"),
                 F.min(F.when(present, F.col("datetime"))).alias("first_ts"),
                 F.max(F.when(present, F.col("datetime"))).alias("last_ts")))


def daily_mean(df: DataFrame, value_cols, keys=("df", "device_id", "column"),
               ts="datetime") -> DataFrame:
    """AGG11: calendar-day mean per key; days without data appear as nulls.

    The day spine per key comes from ``sequence(first_day, last_day)``, so
    its size is bounded by the key's time span in days.
    """
    day = F.to_date(F.col(ts)).alias("day")
    agg = df.groupBy(*keys, day).agg(*[F.avg(c).alias(c) for c in value_cols])
    span = (agg.groupBy(*keys).agg(F.min("day").alias("_d0"), F.max("day").alias("_d1"))
            .select(*keys, F.explode(F.sequence("_d0", "_d1")).alias("day")))
    return span.join(agg, [*keys, "day"], "left")


def rolling_band_summary(rolling: DataFrame, keys=("df", "column")) -> DataFrame:
    """AGG12: exact median over time of roll_min / roll_median / roll_max, by
    one aggregate over one pass of the rolling window; null keys are a group."""
    bands = (("roll_min", "band_min"), ("roll_median", "band_center"), ("roll_max", "band_max"))
    return rolling.groupBy(*keys).agg(*[F.percentile(src, F.lit(0.5)).alias(dst) for src, dst in bands])


def duplicate_timestamps(df: DataFrame, keys, ts: str) -> DataFrame:
    """AGG6: rows minus distinct timestamps per key."""
    return (df.groupBy(*keys)
            .agg(F.count("*").alias("rows"), F.countDistinct(ts).alias("distinct_ts"))
            .withColumn("duplicates", F.col("rows") - F.col("distinct_ts")))


def null_profile(df: DataFrame, cols) -> DataFrame:
    """AGG19: null count per field, as (field, nulls, rows) rows."""
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]
    wide = df.agg(F.count("*").alias("_rows"), *aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr("_rows AS rows", f"stack({len(cols)}, {stack}) AS (field, nulls)")


def gps_fix_ratio(df: DataFrame, keys, location: str = "location") -> DataFrame:
    """AGG10: rows with a location over all rows."""
    return (df.groupBy(*keys).agg(F.count(location).alias("with_fix"), F.count("*").alias("rows"))
            .withColumn("fix_ratio", F.col("with_fix") / F.col("rows")))


def with_labels(df: DataFrame, col: str = "column") -> DataFrame:
    """AGG14: split '<base>_<device>' into base_column and device_label."""
    base, label = label_split(F.col(col))
    return df.withColumn("base_column", base).withColumn("device_label", label)

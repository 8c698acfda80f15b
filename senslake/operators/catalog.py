"""PRJ34-37: catalog navigation over long-form study tables."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def get(long_df: DataFrame, tables=None, devices=None, columns=None, known_tables=None) -> DataFrame:
    """Select by table(s), device(s) and column(s). A single unknown name
    raises; unknown items of a list warn and are skipped. ``known_tables``
    (plan-time metadata) enables the check without scanning data."""
    def norm(x):
        return None if x is None else ([x] if isinstance(x, str) else list(x))
    tables, devices, columns = norm(tables), norm(devices), norm(columns)
    if tables is not None and known_tables is not None:
        missing = [t for t in tables if t not in known_tables]
        if missing and len(tables) == 1:
            raise KeyError(f"table not found: {missing[0]}")
        for t in missing:
            warnings.warn(f"table not found: {t}")
        tables = [t for t in tables if t in known_tables]
    out = long_df
    if tables is not None:
        out = out.where(F.col("df").isin(tables))
    if devices is not None:
        out = out.where(F.col("device_id").isin(devices))
    if columns is not None:
        out = out.where(F.col("column").isin(columns))
    return out.select("df", "device_id", "datetime", "column", "value")


def numeric_columns(df: DataFrame) -> list[str]:
    """PRJ36: numeric, non-boolean columns other than datetime/date/time."""
    skip = {"datetime", "date", "time"}
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, T.NumericType)]


def resolve_targets(available, names=(), skip=("all",)):
    """PRJ37: named tables, or all but ``skip``; unknown names -> None with a message."""
    if names:
        bad = [n for n in names if n not in available]
        if bad:
            print(f"df(s) not found: {bad}. Available: {[a for a in available if a not in skip]}")
            return None
        return list(names)
    return [a for a in available if a not in skip]

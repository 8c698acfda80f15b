"""Registry of named queries: Spark callable + equivalent DuckDB SQL.

Keys are prefixed by the operator ID of the blueprint inventory (``agg2_``,
``win1_`` ...). Each callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame; the SQL (when the operator is SQL-expressible) runs on DuckDB over
the same Parquet tables and must produce the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from senslake.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# Doubles are rounded to this many digits in query output so that a value
# hash is stable across engines (summation order differs in the last bits).
DIGITS = 6


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run
    return deco


def r(c, digits: int = DIGITS) -> Column:
    """Round a double column for output."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column of ``df`` in place (names kept)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)

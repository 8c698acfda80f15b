"""Parquet scans of the study tables.

Each table is one Parquet dataset; Catalyst prunes columns and pushes
filters into the scan, so callers read the table whole and project late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views for ``spark.sql``."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)

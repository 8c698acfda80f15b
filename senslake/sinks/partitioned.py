"""SNK2: upsert that rewrites only the partitions a pull touches.

A table is a folder of ``day=.../bucket=...`` partitions. A merge reads and
replaces the partitions that hold keys of the source; all other files stay as
they are. Versions are compared by the stored order columns, so a late or
repeated pull never replaces a newer version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from senslake.session import materialize
from senslake.sinks.load import TableSpec, latest_per_key

def _place() -> Column:
    """What names a partition, as one value: a null day has a partition of its own."""
    return F.concat_ws("/", F.coalesce(F.col("day").cast("string"), F.lit("none")), F.col("bucket").cast("string"))


def placed(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows`` with the day of their time and the bucket of their device."""
    return rows.withColumns({"day": F.to_date(spec.time), "bucket": F.pmod(F.xxhash64(spec.key[0]), F.lit(spec.buckets)).cast("int")})


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table; ``schema`` (columns without day and bucket) spares the inference."""
    cols = T.StructType([f for f in schema.fields if f.name not in ("day", "bucket")]).add("day", "date").add("bucket", "integer")
    return spark.read.schema(cols).parquet(path)


def touched(target: DataFrame, places: list[str]) -> DataFrame:
    """Rows of the named partitions: a predicate on partition columns alone, so other files are not listed as input."""
    return target.where(_place().isin(places))


def merge_days(source: DataFrame, path: str, spec: TableSpec) -> list[str]:
    """Upsert ``source`` into the table at ``path``; returns the partitions rewritten ('day/bucket').

    The partitions that the source touches are collected (one short value each). Of a key's versions the greatest
    ``spec.order`` wins, the source's on a tie: merging the same pull twice changes nothing, and neither does the
    order in which pulls arrive. The rewrite is dynamic partition overwrite: staged, then swapped in partition by
    partition at the job's commit; a merge that is cut short there is run again."""
    spark = source.sparkSession
    src = materialize(spark, placed(source, spec), f"merge-{spec.name}")
    places = [r[0] for r in src.select(_place()).distinct().collect()]
    if not places:
        return []
    rows = src.withColumn("_src", F.lit(1))
    if _exists(spark, path):
        old = read_days(spark, path, src.schema)
        rows = touched(old, places).withColumn("_src", F.lit(0)).unionByName(rows)
    order = [*[c for c in spec.order if c in source.columns], "_src"]
    merged = latest_per_key(rows, [*spec.key, "day", "bucket"], order).drop("_src").select(*src.columns)
    # AQE splits a large (day, bucket) over tasks and joins small ones: few files, no hot writer.
    (merged.hint("rebalance", "day", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "bucket").parquet(path))
    return sorted(places)

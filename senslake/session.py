"""Session construction and cluster-shared folders.

On a cluster the session arrives configured; we only fill in settings that
are unset, so a deployment's own values (shuffle partitions, checkpoint dir)
always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC session time keeps TIMESTAMP <-> NTZ casts
# stable; AQE coalesces small shuffles and splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "senslake",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_defaults(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("SENSLAKE_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Force UTC session time; fill other defaults only where unset."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object store) folder there, and must: only
    a local master, whose tasks share the driver's disk, gets a scratch folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="senslake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


#: Row group bytes of landed frames. A task reads whole row groups: of the default size one would hold a million payloads.
ROW_GROUP = 4 << 20


def write_split(df, path: str) -> None:
    """Write Parquet that readers can split however few tasks wrote it."""
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)


def materialize(spark: SparkSession, df, name: str):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it back.

    For a frame that feeds several branches or long plans: a lost executor
    repeats no finished work, and nothing stays in executor memory."""
    import uuid
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    write_split(df, path)
    return spark.read.schema(df.schema).parquet(path)

"""Load step: raw append, failure isolation, upsert, FK resolution, run log.

Pure ``DataFrame -> DataFrame`` functions compute what a table must contain;
the ``write_*`` functions persist it. A write never reads and overwrites the
same path in one plan: the merged table goes to a new version folder and the
caller points readers at it (or a catalog with MERGE INTO is used instead).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from senslake.operators.joins import maybe_broadcast


@dataclass(frozen=True)
class TableSpec:
    """Destination table: name, natural key, partition columns; the time that
    names a row's day and the buckets per day of a day-partitioned table."""
    name: str
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    order: tuple[str, ...] = ("pulled_at", "point_pos")
    time: str = "recorded_at"
    buckets: int = 1
    device_type: str = "wearable"


# Destination tables and their natural keys.
TABLES = {
    "readings": TableSpec("readings", ("device_id", "data_type", "recorded_at", "metric", "tag"),
                          ("data_type",)),
    "sleep_sessions": TableSpec("sleep_sessions", ("device_id", "started_at"), time="started_at"),
    "exercise_sessions": TableSpec("exercise_sessions", ("device_id", "started_at"), time="started_at"),
    # The pull time is in a snapshot's key: of two with one key the greater values win, whichever came first.
    "profile": TableSpec("profile", ("device_id", "recorded_at"),
                         order=("age", "membership_start_date", "walking_stride_mm", "running_stride_mm")),
    "air_readings": TableSpec("air_readings", ("device_id", "recorded_at"), device_type="air"),
    "sleep_stages": TableSpec("sleep_stages", ("session_id", "started_at"),
                              order=("pulled_at", "point_pos", "stage_pos"), time="started_at"),
}


def with_ingest_id(raw: DataFrame) -> DataFrame:
    """SNK1 key: deterministic ingest id from (device_type, device_id, pulled_at)."""
    if "ingest_id" in raw.columns:
        return raw
    return raw.withColumn("ingest_id", F.xxhash64("device_type", "device_id", "pulled_at"))


def write_raw(raw: DataFrame, path: str) -> None:
    """SNK1: append-only raw ingest log, partitioned by device type."""
    (with_ingest_id(raw).write.mode("append").partitionBy("device_type").parquet(path))


def failed_devices(*tables: DataFrame, key: str = "device_id") -> DataFrame:
    """D13: devices with at least one bad row in any table of the batch (those with
    an ``error`` column), with the first (smallest) error message."""
    errs = [t.where(F.col("error").isNotNull()).select(key, "error") for t in tables if "error" in t.columns]
    u = reduce(lambda a, b: a.unionByName(b), errs)
    return u.groupBy(key).agg(F.min("error").alias("error_message"))


def isolate(table: DataFrame, failed: DataFrame, key: str = "device_id") -> DataFrame:
    """Drop every row of a failed device (the per-device rollback)."""
    return table.join(maybe_broadcast(failed.select(key)), key, "left_anti")


def latest_per_key(rows: DataFrame, key, order, versions: str | None = None) -> DataFrame:
    """WIN3 / D1 / D2: one row per natural key, the greatest ``order`` wins;
    ``versions`` names a column for the number of rows that had the key.

    Keys compare null-safe (grouping puts nulls together). ``max_by`` keeps
    one candidate per group in the aggregation buffer, with map-side
    combine, so re-pulled hot keys do not gather in one task.
    """
    key = list(key)
    rest = [c for c in rows.columns if c not in key]
    count = [F.count("*").alias(versions)] if versions else []
    if not rest:
        return rows.groupBy(*key).agg(*count) if count else rows.select(*key).distinct()
    win = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return rows.groupBy(*key).agg(win.alias("_w"), *count).select(*key, "_w.*", *([versions] if versions else []))


def upsert(target: DataFrame | None, source: DataFrame, key, order) -> DataFrame:
    """SNK2: insert new keys, replace non-key columns of existing keys.

    Source rows beat target rows; inside the source the greatest ``order``
    wins (latest pull, then last position). Columns must match by name.
    """
    src = source.withColumn("_src", F.lit(1))
    if target is None:
        u = src
    else:
        missing = set(source.columns) ^ set(target.columns)
        if missing:
            raise ValueError(f"upsert column mismatch: {sorted(missing)}")
        u = target.withColumn("_src", F.lit(0)).unionByName(src)
    return latest_per_key(u, key, ["_src", *order]).drop("_src")


def insert_if_absent(target: DataFrame, source: DataFrame, key) -> DataFrame:
    """SNK3: ON CONFLICT DO NOTHING -- source rows whose key is new, one per
    key (keys compare null-safe; of several the one that sorts first)."""
    key = list(key)
    rest = [c for c in source.columns if c not in key]
    one = source.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, "_r.*") if rest else source.distinct()
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in key]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in key]
    new = one.join(t, reduce(lambda a, b: a & b, same), "left_anti")
    return target.unionByName(new.select(*source.columns))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a table: only a finished write leaves ``_SUCCESS``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def write_table(df: DataFrame, path: str, spec: TableSpec) -> int:
    """Persist a merged table as the next version, in a folder of its own: the
    plan may read the current version, and a write that fails leaves it as it is."""
    version = max(_versions(df.sparkSession, path), default=0) + 1
    w = df.write.mode("overwrite")
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    w.parquet(f"{path}/version={version}")
    return version


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A committed version of a table, the latest by default; None before the first."""
    known = _versions(spark, path)
    if version is None and known:
        version = known[-1]
    return spark.read.parquet(f"{path}/version={version}") if version in known else None


def merge_table(source: DataFrame, path: str, spec: TableSpec) -> int:
    """SNK2 persisted: upsert ``source`` into the latest version of the table."""
    order = [c for c in spec.order if c in source.columns]
    return write_table(upsert(read_table(source.sparkSession, path), source, spec.key, order), path, spec)


def write_json(df: DataFrame, path: str) -> None:
    """SNK5: a result as JSON lines, nulls kept as fields."""
    df.write.option("ignoreNullFields", "false").json(path)


def session_ids(sessions: DataFrame) -> DataFrame:
    """WIN6: deterministic surrogate key, stable across re-pulls: the MD5 of
    the natural key (start in microseconds; null parts are named), 128 bits,
    so that billions of sessions do not collide."""
    start = F.unix_micros(F.col("started_at").cast("timestamp"))
    parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in (F.col("device_id"), start)]
    return sessions.withColumn("session_id", F.md5(F.concat_ws("|", *parts)))


def resolve_stages(stages: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN1: stage -> parent session on (device_id, session start).

    Returns (resolved stages with session_id, rejected stages). Sessions and
    stages are both large; the equi-join shuffles both on the device key.
    """
    s = session_ids(sessions).select("device_id", F.col("started_at").alias("session_started_at"),
                                     "session_id")
    on = ["device_id", "session_started_at"]
    resolved = stages.join(s, on, "inner")
    rejected = stages.join(s, on, "left_anti")
    return resolved, rejected


def run_log(batch_devices: DataFrame, failed: DataFrame, started_at: Column | None = None) -> DataFrame:
    """SNK6: one row per (device_type, device_id) of the batch: success or
    failed with the error message. A failure counts for its device type alone
    where ``failed`` names one."""
    on = [c for c in ("device_type", "device_id") if c in failed.columns]
    out = batch_devices.join(maybe_broadcast(failed), on, "left")
    status = F.when(F.col("error_message").isNull(), "success").otherwise("failed")
    cols = ["device_type", "device_id", status.alias("status"), "error_message", *[c for c in ("pulled_to",) if c in batch_devices.columns]]
    if started_at is not None:
        cols.append(started_at.alias("started_at"))
    return out.select(*cols)


def expected_vs_stored(parsed: DataFrame, stored: DataFrame, keys) -> DataFrame:
    """JN11: parser row count vs stored row count per key: equal/less/more."""
    a = parsed.groupBy(*keys).agg(F.count("*").alias("expected"))
    b = stored.groupBy(*keys).agg(F.count("*").alias("stored"))
    j = a.join(b, list(keys), "full_outer").fillna(0, ["expected", "stored"])
    return j.withColumn("status", F.when(F.col("stored") == F.col("expected"), "equal")
                        .when(F.col("stored") < F.col("expected"), "less").otherwise("more"))


def fk_violations(child: DataFrame, parent: DataFrame, child_key, parent_key) -> DataFrame:
    """JN10: child rows whose parent key does not exist."""
    cond = reduce(lambda a, b: a & b, [child[c] == parent[p] for c, p in zip(child_key, parent_key)])
    return child.join(parent.select(*parent_key), cond, "left_anti")


def last_successful_pull(runs: DataFrame) -> DataFrame:
    """AGG18: latest successful start per device (the incremental resume point)."""
    return (runs.where(F.col("status") == "success")
            .groupBy("device_type", "device_id").agg(F.max("started_at").alias("last_success")))


def since_last_success(raw: DataFrame, resume: DataFrame, at: str = "pulled_to") -> DataFrame:
    """Incremental pull: the rows of ``raw`` after their device's resume point
    (``resume``: device_type, device_id, ``at``); all rows of a device that never succeeded."""
    r = resume.select("device_type", "device_id", F.col(at).alias("_since"))
    j = raw.join(maybe_broadcast(r), ["device_type", "device_id"], "left")
    return j.where(F.col("_since").isNull() | (F.col("pulled_at") > F.col("_since"))).select(*raw.columns)


def load_type(device_type: str, raw: DataFrame, tz: DataFrame | None = None, versions: str | None = None) -> dict:
    """Load of one device type's pulls in a batch, by its registered parser
    (EXT1): parse, isolate failed devices once, upsert-ready tables, stages
    resolved to loaded sessions, run log.

    ``raw`` carries a ``timezone`` column, or ``tz`` (device_id, timezone)
    is joined in (JN6). An unreadable payload or time, or a value that does
    not cast, fails its device alone. The parser lands what several tables
    are derived from, the tables that can fail are landed before they are
    judged (their errors and their rows come from one parse), and so are the
    failed devices: nothing is persisted.
    ``versions`` as in :func:`latest_per_key`.
    """
    from senslake.operators.parsers import PARSERS
    from senslake.session import materialize
    from senslake.sources import payloads

    if "timezone" not in raw.columns:
        raw = raw.join(maybe_broadcast(tz), "device_id", "left")
    parsed = {name: materialize(raw.sparkSession, t, f"parsed-{name}") if "error" in t.columns else t
              for name, t in PARSERS[device_type](raw).items()}
    failed = failed_devices(payloads.payload_errors(raw), *parsed.values())
    failed = materialize(raw.sparkSession, failed.select(F.lit(device_type).alias("device_type"), "*"), "failed")

    def loaded(name: str, rows: DataFrame) -> DataFrame:
        order = [c for c in TABLES[name].order if c in rows.columns]
        return latest_per_key(rows, TABLES[name].key, order, versions)

    ok = {name: isolate(t, failed).drop("error") for name, t in parsed.items()}
    out = {name: loaded(name, t) for name, t in ok.items() if name != "sleep_stages"}
    if "sleep_stages" in ok:
        resolved, out["stage_rejects"] = resolve_stages(ok["sleep_stages"], out["sleep_sessions"])
        out["sleep_stages"] = loaded("sleep_stages", resolved.drop("device_id", "session_started_at"))
    devices = raw.groupBy(F.lit(device_type).alias("device_type"), "device_id").agg(F.max("pulled_at").alias("pulled_to"))
    return {**out, "failed": failed, "parsed": parsed, "run_log": run_log(devices, failed), "cached": []}


def load_wearable_batch(spark: SparkSession, raw: DataFrame, tz: DataFrame | None = None) -> dict:
    """The wearable pulls of one batch (:func:`load_type`)."""
    return load_type("wearable", raw, tz)


def load_air_batch(raw: DataFrame, tz: DataFrame | None = None) -> dict:
    """The air-sensor pulls of one batch (:func:`load_type`)."""
    return load_type("air", raw, tz)


def load_batch(raw: DataFrame, tz: DataFrame | None = None, versions: str | None = None) -> dict:
    """Whole load of one batch of pulls: every registered device type by its
    parser, isolated per (device type, device). ``run_log`` covers all types;
    ``unrouted`` are the pulls of types without a parser, as they came."""
    from senslake.operators.parsers import PARSERS
    types = {t: load_type(t, raw.where(F.col("device_type") == t), tz, versions) for t in PARSERS}
    out = {name: df for one in types.values() for name, df in one.items()}
    for name in ("failed", "run_log"):
        out[name] = reduce(DataFrame.unionByName, [one[name] for one in types.values()])
    out["parsed"] = {name: df for one in types.values() for name, df in one["parsed"].items()}
    out["unrouted"] = raw.where(~F.coalesce(F.col("device_type").isin(list(PARSERS)), F.lit(False)))
    return out

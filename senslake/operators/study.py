"""Study registries and assignment logic (SRC6, SRC7, WIN4, JN7, JN8, SCL13-15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from senslake.functions.time import date_chunks, open_until
from senslake.registry import AIR_PULL_DAYS, ROLLUP_DAYS, ROLLUP_DAYS_OTHER


def flatten_devices(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """SRC6: every ``*_devices`` list of every document -> one row per entry;
    keys compared case-insensitively; entries without id or type are
    rejected (``valid`` = false) instead of failing the load."""
    m = F.from_json(F.col(doc), "map<string,string>")
    lists = docs.select(F.explode(m).alias("list_key", "list_json")) \
        .where(F.col("list_key").endswith("_devices"))
    entries = lists.select("list_key", F.explode(F.from_json("list_json", "array<map<string,string>>"))
                           .alias("e"))
    e = entries.select("list_key", F.transform_keys("e", lambda k, v: F.lower(k)).alias("e"))
    g = lambda k: F.element_at("e", F.lit(k))
    return e.select("list_key", g("id").alias("device_id"), g("type").alias("device_type"),
                    g("site").alias("site"), g("timezone").alias("timezone"),
                    g("start_date").cast("date").alias("start_date"), g("mac").alias("mac"),
                    (g("id").isNotNull() & g("type").isNotNull()).alias("valid"))


_ASSIGN = ("array<struct<device_id:string,assigned_from:string,assigned_until:string>>")


def flatten_assignments(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """SRC7: participants with nested ``device_assignments`` -> one row each."""
    p = docs.select(F.from_json(F.col(doc), f"struct<id:string,enrolled_at:string,device_assignments:{_ASSIGN}>")
                    .alias("p"))
    return p.select(F.col("p.id").alias("participant_id"),
                    F.explode("p.device_assignments").alias("a")).select(
        "participant_id", F.col("a.device_id").cast("long").alias("device_id"),
        F.col("a.assigned_from").cast("date").alias("assigned_from"),
        F.col("a.assigned_until").cast("date").alias("assigned_until"))


def overlapping_assignments(assign: DataFrame) -> DataFrame:
    """WIN4 / D25: assignments starting before an earlier assignment of the
    same device has ended (ranges half-open, null end = open)."""
    w = (Window.partitionBy("device_id").orderBy("assigned_from", "assignment_id")
         .rowsBetween(Window.unboundedPreceding, -1))
    prev_end = F.max(open_until(F.col("assigned_until"))).over(w)
    return assign.withColumn("prev_until", prev_end).where(F.col("prev_until") > F.col("assigned_from"))


def plan_pulls(ranges: DataFrame, types: dict) -> DataFrame:
    """SCL13 per data type: ``types`` names the data types of each device type; chunks are as long as the API
    allows the type (``registry.ROLLUP_DAYS``, ``AIR_PULL_DAYS``)."""
    longest = {t: {d: AIR_PULL_DAYS if t == "air" else ROLLUP_DAYS.get(d, ROLLUP_DAYS_OTHER) for d in names} for t, names in types.items()}
    plans = []
    for days in sorted({n for of in longest.values() for n in of.values()}):
        names = F.create_map(*[F.lit(x) for t, of in longest.items() for x in (t, ",".join(d for d, n in of.items() if n == days))])
        data_type = F.explode(F.split(F.nullif(names[F.col("device_type")], F.lit("")), ",")).alias("data_type")
        plans.append(pull_chunks(ranges.select("*", data_type), days))
    return reduce(DataFrame.unionByName, plans)


def pull_chunks(ranges: DataFrame, days: int, start: str = "pull_start", end: str = "pull_end") -> DataFrame:
    """SCL13: split each (device, start, end) range into chunks of <= days."""
    return ranges.select("*", F.explode(date_chunks(F.col(start), F.col(end), days)).alias("c")) \
        .select(*ranges.columns, "c.chunk_start", "c.chunk_end")

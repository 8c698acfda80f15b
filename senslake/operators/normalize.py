"""Wearable normalisation (PRJ2-17): data points -> typed study tables.

Every registry kind and bespoke reading type compiles into ONE ``CASE
data_type`` expression producing ``array<struct<metric, tag, value_raw>>``,
exploded once, so a payload is scanned a single time whatever mix of types
it carries. Time grain is a second ``CASE`` producing (grain, start, end,
error). Rows with an error (no usable date, device without timezone,
non-numeric value, missing time) are kept with ``error`` set, so the load
step can fail exactly those devices (per-device isolation).

Input: the output of ``sources.payloads.wearable_points`` joined with the
device dimension's ``timezone`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from senslake.functions.time import civil_date, iso_to_utc, local_midnight_utc, seconds_str
from senslake.registry import (BESPOKE_TYPES, DROPPED_TYPES, EXERCISE_ZONE_TIMES, HR_ZONE_BOUNDS,
                               RESPIRATORY_FIELDS, RESPIRATORY_STAGES, UNMAPPED_TYPES,
                               WEARABLE_REGISTRY, camel)

_P = "point"


def _null_s() -> Column:
    return F.lit(None).cast("string")


def vget(path: str, typ: str = "string", v: str | Column = _P) -> Column:
    """PRJ2: dotted-path lookup; null when any level is missing."""
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, typ)


def _item(metric, tag, value, keep=None) -> Column:
    metric = F.lit(metric) if isinstance(metric, str) else metric
    keep = F.lit(True) if keep is None else keep
    return F.struct(metric.alias("metric"), tag.alias("tag"), value.alias("value_raw"), keep.alias("keep"))


def _present(path: str, v=_P) -> Column:
    """Key present (JSON null counts as present)."""
    return vget(path, "variant", v).isNotNull()


# Kinds whose rows come from a list inside the point (one row per element).
_LIST_TYPES = [t for t, r in WEARABLE_REGISTRY.items() if r["kind"] == "list_fanout"] + ["daily-heart-rate-zones"]


def _fixed_items(data_type: str) -> Column:
    """PRJ3-5, PRJ7-8, PRJ10: a fixed-size array per point; ``keep`` marks
    the elements that become rows (no lambda functions: the whole
    expression stays in generated code)."""
    n = f"$.{camel(data_type)}"
    if data_type == "respiratory-rate-sleep-summary":           # PRJ10: only absent keys skipped
        n = "$.respiratoryRateSleepSummary"
        return F.array(*[_item(metric, F.lit(tag), vget(f"{n}.{stage}.{field}"),
                               _present(f"{n}.{stage}.{field}"))
                         for stage, tag in RESPIRATORY_STAGES.items()
                         for field, metric in RESPIRATORY_FIELDS.items()])
    rule = WEARABLE_REGISTRY[data_type]
    kind = rule["kind"]
    if kind == "scalar":                                           # PRJ3
        return F.array(_item(rule["metric"], _null_s(), vget(f"{n}.{rule['value_field']}")))
    if kind == "categorical":                                      # PRJ4
        return F.array(_item(rule["metric"], vget(f"{n}.{rule['state_field']}"), _null_s()))
    if kind == "tagged_scalar":                                    # PRJ5
        return F.array(_item(rule["metric"], vget(f"{n}.{rule['tag_field']}"),
                             vget(f"{n}.{rule['value_field']}")))
    if kind == "tag_map":                                          # PRJ7: nulls skipped
        cells = [(F.lit(tag), vget(f"{n}.{field}")) for field, tag in rule["tag_map"].items()]
        return F.array(*[_item(rule["metric"], tag, v, v.isNotNull()) for tag, v in cells])
    if kind == "field_map":                                        # PRJ8: nulls skipped
        cells = [(metric, vget(f"{n}.{field}")) for field, metric in rule["fields"].items()]
        return F.array(*[_item(metric, _null_s(), v, v.isNotNull()) for metric, v in cells])
    raise ValueError(f"no fixed items for {data_type}")


def _list_of(data_type: str) -> Column:
    """The list a list-kind point fans out over (absent -> null)."""
    if data_type == "daily-heart-rate-zones":
        return vget("$.dailyHeartRateZones.heartRateZones", "array<variant>")
    rule = WEARABLE_REGISTRY[data_type]
    return vget(f"$.{camel(data_type)}.{rule['list_field']}", "array<variant>")


def _list_item_rows(data_type: str, item: Column) -> Column:
    """PRJ6 / PRJ9: the rows one list element produces."""
    if data_type == "daily-heart-rate-zones":                  # PRJ9: null bounds kept
        name = F.coalesce(vget("$.heartRateZoneType", v=item), F.lit("None"))
        return F.array(*[_item("hr_zone_bpm", F.concat(name, F.lit(f"_{suffix}")), vget(f"$.{bound}", v=item))
                         for bound, suffix in HR_ZONE_BOUNDS.items()])
    rule = WEARABLE_REGISTRY[data_type]                          # PRJ6
    return F.array(_item(rule["metric"], vget(f"$.{rule['tag_field']}", v=item),
                         vget(f"$.{rule['value_field']}", v=item)))


def _case(pairs) -> Column:
    expr = None
    for t, c in pairs:
        cond = F.col("data_type") == t
        expr = F.when(cond, c) if expr is None else expr.when(cond, c)
    return expr


def readings_items() -> Column:
    """Fixed-shape readings array per point (non-list kinds)."""
    fixed = [t for t in WEARABLE_REGISTRY if t not in _LIST_TYPES] + ["respiratory-rate-sleep-summary"]
    return _case([(t, _fixed_items(t)) for t in fixed])


def list_items() -> Column:
    return _case([(t, _list_of(t)) for t in _LIST_TYPES])


def list_item_rows(item: Column) -> Column:
    empty = F.array().cast("array<struct<metric:string,tag:string,value_raw:string,keep:boolean>>")
    return _case([(t, F.when(item.isNull(), empty).otherwise(_list_item_rows(t, item))) for t in _LIST_TYPES])


def _grain_of(data_type: str) -> tuple[str, str]:
    if data_type in WEARABLE_REGISTRY:
        r = WEARABLE_REGISTRY[data_type]
        return r["grain"], r.get("date_source", "nested")
    return {"daily-heart-rate-zones": ("daily", "nested"),
            "respiratory-rate-sleep-summary": ("sample", "nested")}[data_type]


def time_span(data_type: str, tz: Column) -> Column:
    """PRJ17: (grain, recorded_at, ended_at, error) of one point."""
    grain, source = _grain_of(data_type)
    n = f"$.{camel(data_type)}"
    none_ts = F.lit(None).cast("timestamp_ntz")
    if grain == "sample":
        start = iso_to_utc(vget(f"{n}.sampleTime.physicalTime"))
        end = none_ts
        err = F.when(start.isNull(), F.lit("sample grain: no usable time"))
    elif grain == "interval":
        start = iso_to_utc(vget(f"{n}.interval.startTime"))
        end = iso_to_utc(vget(f"{n}.interval.endTime"))
        err = F.when(start.isNull(), F.lit("interval grain: no usable start"))
    else:
        base = "$.civilStartTime.date" if source == "civil" else f"{n}.date"
        d = civil_date(vget(f"{base}.year", "int"), vget(f"{base}.month", "int"),
                       vget(f"{base}.day", "int"))
        start, end = local_midnight_utc(d, tz)
        err = (F.when(d.isNull(), F.lit(f"daily grain: no usable date at {base}"))
               .when(tz.isNull(), F.lit("daily grain: device has no timezone"))
               .when(start.isNull(), F.lit("daily grain: unknown timezone")))
    return F.struct(F.lit(grain).alias("grain"), start.alias("recorded_at"),
                    end.alias("ended_at"), err.alias("error"))


def time_spans(tz: Column) -> dict:
    """Per-type CASEs for grain, recorded_at, ended_at and error.

    Four separate columns rather than one struct: a struct CASE read field
    by field after the explode would be re-evaluated once per field.
    """
    parts = {"grain": None, "recorded_at": None, "ended_at": None, "error": None}
    for t in [*WEARABLE_REGISTRY, "daily-heart-rate-zones", "respiratory-rate-sleep-summary"]:
        cond = F.col("data_type") == t
        span = time_span(t, tz)
        for name in parts:
            c = span[name]
            parts[name] = F.when(cond, c) if parts[name] is None else parts[name].when(cond, c)
    return parts


def route(data_type: Column) -> Column:
    """PRJ15: registry / bespoke / dropped / unmapped / unrecognised."""
    return (F.when(data_type.isin(list(WEARABLE_REGISTRY)), "registry")
            .when(data_type.isin(BESPOKE_TYPES), "bespoke")
            .when(data_type.isin(DROPPED_TYPES), "dropped")
            .when(data_type.isin(UNMAPPED_TYPES), "unmapped")
            .otherwise("unrecognised"))


def route_counts(points: DataFrame) -> DataFrame:
    """PRJ15 report: points per (route, data_type)."""
    return points.groupBy(route(F.col("data_type")).alias("route"), "data_type") \
        .agg(F.count("*").alias("points"))


def readings(points: DataFrame, tz: str = "timezone") -> DataFrame:
    """Normalised readings with value_text (PRJ16) and a per-row error.

    Output: device_id, data_type, grain, recorded_at, ended_at, metric, tag,
    value_numeric, value_text, ingest_id, pulled_at, point_pos, error.
    """
    tz_c = F.col(tz)
    producing = [*WEARABLE_REGISTRY, "daily-heart-rate-zones", "respiratory-rate-sleep-summary"]
    p = points.where(F.col("data_type").isin(producing))
    spans = time_spans(tz_c)
    # Spans are computed once per point, before any explode.
    base = p.select("device_id", "data_type", "ingest_id", "pulled_at", "point_pos", "point",
                    *[c.alias(f"_t_{n}") for n, c in spans.items()])
    t_cols = [f"_t_{n}" for n in spans]
    keys = ["device_id", "data_type", "ingest_id", "pulled_at", "point_pos", *t_cols]
    step = base.select(*keys, "point", readings_items().alias("_fixed"),
                       F.explode_outer(list_items()).alias("_item"))
    rows = F.when(F.col("data_type").isin(_LIST_TYPES), list_item_rows(F.col("_item"))) \
        .otherwise(F.col("_fixed"))
    x = step.select(*keys, F.explode(rows).alias("_r")).where(F.col("_r.keep"))
    value = F.col("_r.value_raw").try_cast("double")
    bad = F.col("_r.value_raw").isNotNull() & value.isNull()
    err = F.coalesce(F.col("_t_error"),
                     F.when(bad, F.concat(F.lit("non-numeric value: "), F.col("_r.value_raw"))))
    tag = F.col("_r.tag")
    return x.select(
        "device_id", "data_type", F.col("_t_grain").alias("grain"),
        F.col("_t_recorded_at").alias("recorded_at"), F.col("_t_ended_at").alias("ended_at"),
        F.col("_r.metric").alias("metric"), tag.alias("tag"), value.alias("value_numeric"),
        value_text(value, tag).alias("value_text"),
        "ingest_id", "pulled_at", "point_pos", err.alias("error"))


def value_text(value: Column, tag: Column) -> Column:
    """PRJ16: the tag, whenever the value is null and the tag is not."""
    return F.when(value.isNull() & tag.isNotNull(), tag)


def _span(prefix: str):
    start = iso_to_utc(vget(f"{prefix}.interval.startTime"))
    end = iso_to_utc(vget(f"{prefix}.interval.endTime"))
    err = F.when(start.isNull() | end.isNull(), F.lit("session without start/end"))
    return start, end, err


def sleep_sessions(points: DataFrame) -> DataFrame:
    """PRJ11: one session row per sleep point."""
    n = "$.sleep"
    start, end, err = _span(n)
    return points.where(F.col("data_type") == "sleep").select(
        "device_id", start.alias("started_at"), end.alias("ended_at"),
        vget(f"{n}.type").alias("sleep_type"),
        vget(f"{n}.metadata.nap", "boolean").alias("is_nap"),
        vget(f"{n}.summary.minutesInSleepPeriod").try_cast("int").alias("minutes_in_sleep_period"),
        vget(f"{n}.summary.minutesAfterWakeUp").try_cast("int").alias("minutes_after_wakeup"),
        vget(f"{n}.summary.minutesToFallAsleep").try_cast("int").alias("minutes_to_fall_asleep"),
        vget(f"{n}.summary.minutesAsleep").try_cast("int").alias("minutes_asleep"),
        vget(f"{n}.summary.minutesAwake").try_cast("int").alias("minutes_awake"),
        "ingest_id", "pulled_at", "point_pos", err.alias("error"))


def sleep_stages(points: DataFrame) -> DataFrame:
    """PRJ12: stage rows carrying their session's start (the parent key)."""
    n = "$.sleep"
    start, _, _ = _span(n)
    stages = F.coalesce(vget(f"{n}.stages", "array<variant>"), F.array().cast("array<variant>"))
    s = points.where(F.col("data_type") == "sleep").select(
        "device_id", start.alias("session_started_at"), "ingest_id", "pulled_at", "point_pos",
        F.posexplode(stages).alias("stage_pos", "_s"))
    st = iso_to_utc(vget("$.startTime", v="_s"))
    en = iso_to_utc(vget("$.endTime", v="_s"))
    return s.select("device_id", "session_started_at", st.alias("started_at"), en.alias("ended_at"),
                    vget("$.type", v="_s").alias("stage_type"), "ingest_id", "pulled_at",
                    "point_pos", "stage_pos",
                    F.when(st.isNull() | en.isNull(), F.lit("stage without start/end")).alias("error"))


def normalised_time(points: DataFrame, types) -> DataFrame:
    """SCL7: ``points`` with ``shape`` and ``t_norm``: sample string, interval
    string, {year, month, day} date, civil {date: {..}}. A type that is not in
    ``types``, or a shape that is not known, is 'unknown' with a null time."""
    t = F.col("data_type")
    shapes, values = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(None).cast("timestamp_ntz"))
    civil = civil_date(*[vget(f"$.civilStartTime.date.{p}", "int") for p in ("year", "month", "day")])
    for dt in types:
        c = camel(dt)
        date = civil_date(*[vget(f"$.{c}.date.{p}", "int") for p in ("year", "month", "day")])
        daily = _present(f"$.{c}") & ~_present("$.civilStartTime") & F.lit(dt.startswith("daily"))
        shape = (F.when(_present(f"$.{c}.sampleTime"), "sample").when(_present(f"$.{c}.interval"), "interval")
                 .when(_present(f"$.{c}.date") | daily, "date")
                 .when(_present("$.civilStartTime"), "civil").otherwise("unknown"))
        value = F.coalesce(iso_to_utc(vget(f"$.{c}.sampleTime.physicalTime")), iso_to_utc(vget(f"$.{c}.interval.startTime")),
                           date.cast("timestamp_ntz"), civil.cast("timestamp_ntz"))
        shapes, values = shapes.when(t == dt, shape), values.when(t == dt, value)
    return points.select("*", shapes.otherwise("unknown").alias("shape"), values.alias("t_norm"))


def exercise_sessions(points: DataFrame) -> DataFrame:
    """PRJ13: one row per exercise, metrics summary flattened, zone
    durations ('1860s') in seconds."""
    n = "$.exercise"
    m = f"{n}.metricsSummary"
    start, end, err = _span(n)
    zones = [seconds_str(vget(f"{m}.heartRateZoneDurations.{k}")).alias(col)
             for k, col in EXERCISE_ZONE_TIMES.items()]
    return points.where(F.col("data_type") == "exercise").select(
        "device_id", start.alias("started_at"), end.alias("ended_at"),
        vget(f"{n}.exerciseType").alias("exercise_type"),
        vget(f"{n}.displayName").alias("display_name"),
        vget(f"{m}.caloriesKcal").try_cast("double").alias("calories_kcal"),
        vget(f"{m}.distanceMillimeters").try_cast("double").alias("distance_mm"),
        vget(f"{m}.steps").try_cast("int").alias("steps"),
        vget(f"{m}.averagePaceSecondsPerMeter").try_cast("double").alias("avg_pace_sec_per_meter"),
        vget(f"{m}.averageHeartRateBeatsPerMinute").try_cast("int").alias("avg_heart_rate_bpm"),
        *zones, "ingest_id", "pulled_at", "point_pos", err.alias("error"))


def profile(sections: DataFrame) -> DataFrame:
    """PRJ14 + SNK4: profile snapshot stamped with the pull time; the
    membership date only when year, month and day are all present."""
    s = "section"
    d = civil_date(vget("$.membershipStartDate.year", "int", s),
                   vget("$.membershipStartDate.month", "int", s),
                   vget("$.membershipStartDate.day", "int", s))
    return sections.select(
        "device_id", F.col("pulled_at").alias("recorded_at"),
        vget("$.age", "string", s).try_cast("int").alias("age"),
        d.alias("membership_start_date"),
        vget("$.userConfiguredWalkingStrideLengthMm", "string", s).try_cast("int").alias("walking_stride_mm"),
        vget("$.userConfiguredRunningStrideLengthMm", "string", s).try_cast("int").alias("running_stride_mm"))

"""The sensor-study model, derived from the driver's tables.

The study tables (devices, readings, sessions, assignments) are views over
the Parquet tables, so every query's work grows with the data:

=====================  ===================================================
study table            derived from
=====================  ===================================================
devices (dimension)    customer -> nation -> region (site, timezone)
readings (long)        events: user_id -> device_id, event_type -> data_type
analysis long frame    events: (df=event_type, device, datetime, column, value)
hourly wide frame      events averaged per hour, one column per event type
sleep sessions/stages  orders (parent) / lineitem (child)
assignments            customer: two periods per device, some overlapping
=====================  ===================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from senslake.session import materialize
from senslake.sources.tables import read_table

# The five event types of the `events` table, in the order the
# hourly wide frame lays them out as columns.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# Region -> IANA timezone for the device dimension. MIDDLE EAST
# stays unset on purpose: devices without a declared timezone (daily-grain
# rows of those devices are rejected, see operators.normalize).
REGION_TZ = {
    "AFRICA": "Africa/Lagos",
    "AMERICA": "America/New_York",
    "ASIA": "Asia/Kolkata",
    "EUROPE": "Europe/Berlin",
}

# Device types by market segment of the customer row.
WEARABLE_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]


def _case(col: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(None).cast("string"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device dimension: id, type, site, timezone, MAC (colon form)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("site"), "r_name")
    hexid = F.lpad(F.hex(F.col("c_custkey")), 12, "0")
    mac = F.concat_ws(":", *[F.substring(hexid, i, 2) for i in range(1, 13, 2)])
    # nation/region are dimension tables of fixed size (25/5 rows).
    return (c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left")
            .select(F.col("c_custkey").alias("device_id"),
                    F.when(F.col("c_mktsegment").isin(WEARABLE_SEGMENTS), "wearable")
                     .otherwise("air").alias("device_type"),
                    "site",
                    _case(F.col("r_name"), REGION_TZ).alias("timezone"),
                    mac.alias("mac")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long readings: one row per event."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("data_type"),
        F.col("ts").alias("recorded_at"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def analysis_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(df, device_id, datetime, column, value): the analysis frame in long form.

    Each event type is one table (``df``); its numeric columns are ``value``
    and ``k``. Long form keeps per-(table, column) statistics a plain group-by.
    """
    r = readings(spark, sf_dir)
    return r.select(
        F.col("data_type").alias("df"),
        F.col("device_id").cast("string").alias("device_id"),
        F.col("recorded_at").alias("datetime"),
        F.explode(F.array(
            F.struct(F.lit("k").alias("column"), F.col("k").cast("double").alias("value")),
            F.struct(F.lit("value").alias("column"), F.col("value").alias("value")),
        )).alias("cv")).select("df", "device_id", "datetime", "cv.column", "cv.value")


def hourly_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means per (device, event type): the present cells of the wide frame."""
    r = readings(spark, sf_dir)
    return (r.groupBy(F.col("device_id").cast("string").alias("device_id"),
                      F.date_trunc("hour", "recorded_at").alias("datetime"),
                      F.col("data_type").alias("column"))
            .agg(F.avg("value").alias("value"))
            .withColumn("df", F.lit("hourly")))


def hourly_spine_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each device's hourly table: hours from its first to last reading."""
    r = readings(spark, sf_dir)
    return (r.groupBy(F.col("device_id").cast("string").alias("device_id"))
            .agg(F.min(F.date_trunc("hour", "recorded_at")).alias("first_hour"),
                 F.max(F.date_trunc("hour", "recorded_at")).alias("last_hour"))
            .select("device_id", "first_hour", "last_hour",
                    ((F.unix_timestamp(F.col("last_hour").cast("timestamp"))
                      - F.unix_timestamp(F.col("first_hour").cast("timestamp"))) / 3600 + 1)
                    .cast("long").alias("rows")))


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device assignments: (assignment_id, device_id, participant_id, assigned_from, assigned_until).

    Per device: participant A from 2024-01-01 for 5..14 days; participant B
    from A's end plus 0..2 days (0 = same-day handover), open-ended. Every
    50th device also lends to a third participant overlapping A's end.
    """
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("device_id"))
    base = F.lit("2024-01-01").cast("date")
    a_until = F.date_add(base, (F.lit(5) + F.col("device_id") % 10).cast("int"))
    rows = F.array(
        F.struct(F.lit(1).alias("seq"), F.concat(F.lit("P"), F.col("device_id")).alias("participant_id"),
                 base.alias("assigned_from"), a_until.alias("assigned_until")),
        F.struct(F.lit(2).alias("seq"), F.concat(F.lit("P"), F.col("device_id") + 1).alias("participant_id"),
                 F.date_add(a_until, (F.col("device_id") % 3).cast("int")).alias("assigned_from"),
                 F.lit(None).cast("date").alias("assigned_until")),
    )
    overlap = F.struct(F.lit(3).alias("seq"), F.concat(F.lit("Q"), F.col("device_id")).alias("participant_id"),
                       F.date_sub(a_until, 2).alias("assigned_from"),
                       F.date_add(a_until, 1).alias("assigned_until"))
    rows = F.when(F.col("device_id") % 50 == 0, F.concat(rows, F.array(overlap))).otherwise(rows)
    return (c.select("device_id", F.explode(rows).alias("a"))
            .select((F.col("device_id") * 10 + F.col("a.seq")).alias("assignment_id"),
                    "device_id", "a.participant_id", "a.assigned_from", "a.assigned_until"))


def sleep_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent sessions from orders: device, start, end (start + 8 h), type."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("session_key"),
        F.col("o_custkey").alias("device_id"),
        F.col("o_orderdate").alias("started_at"),
        (F.col("o_orderdate") + F.expr("INTERVAL 8 HOURS")).alias("ended_at"),
        F.col("o_orderpriority").alias("sleep_type"))


def sleep_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child stage rows from lineitem, pointing at their session by key."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("session_key"),
        F.col("l_linenumber").alias("stage_no"),
        F.col("l_shipdate").alias("started_at"),
        (F.col("l_shipdate") + F.expr("INTERVAL 30 MINUTES")).alias("ended_at"),
        F.col("l_returnflag").alias("stage_type"))


def file_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping per-device export files, as legacy CSV downloads produced them.

    file A: days 1-20 of January 2024, key ``<id>_01-Jan-2024_20-Jan-2024``
    file B: days 15-30 (re-export: a value differs when k % 7 = 0, and an
            extra ``firmware`` column), key ``<id>_15-Jan-2024_30-Jan-2024``
    file C: every 10th device, day 30 again, identical to B, key ``<id>_30-Jan-2024``
    file D: every 25th device, day 1 again, key with an unparsable first date
            ``<id>_31-Foo-2024_01-Jan-2024``
    Columns: file_key, device_id (string), datetime, event_type, value, k[, firmware].
    """
    r = readings(spark, sf_dir).select(
        F.col("device_id").cast("string").alias("device_id"),
        F.col("recorded_at").alias("datetime"), F.col("data_type").alias("event_type"),
        "value", "k")
    day = F.dayofmonth("datetime")
    key = lambda suffix: F.concat(F.col("device_id"), F.lit(suffix))
    a = r.where(day <= 20).withColumn("file_key", key("_01-Jan-2024_20-Jan-2024"))
    b = (r.where(day >= 15)
         .withColumn("value", F.when(F.col("k") % 7 == 0, F.col("value") + 1).otherwise(F.col("value")))
         .withColumn("firmware", F.lit("2.1"))
         .withColumn("file_key", key("_15-Jan-2024_30-Jan-2024")))
    c = (r.where((day == 30) & (F.col("device_id").cast("long") % 10 == 0))
         .withColumn("value", F.when(F.col("k") % 7 == 0, F.col("value") + 1).otherwise(F.col("value")))
         .withColumn("firmware", F.lit("2.1"))
         .withColumn("file_key", key("_30-Jan-2024")))
    d = (r.where((day == 1) & (F.col("device_id").cast("long") % 25 == 0))
         .withColumn("file_key", key("_31-Foo-2024_01-Jan-2024")))
    return (a.unionByName(b, allowMissingColumns=True)
            .unionByName(c, allowMissingColumns=True)
            .unionByName(d, allowMissingColumns=True))


def hourly_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per device, one row per hour with data and one column per event type."""
    h = hourly_long(spark, sf_dir)
    return (h.groupBy("device_id", "datetime").pivot("column", EVENT_TYPES)
            .agg(F.first("value")))


# ---------------------------------------------------------------------------
# Landed payloads built from events (one payload per event: bounded size).
# ---------------------------------------------------------------------------

# JSON null marker: to_json drops null fields (= absent keys); a field that
# must be present-but-null carries this marker, replaced after serialising.
_JSON_NULL = "__json_null__"


def _iso_z(ts) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def _iso_ist(ts) -> Column:
    """Same instant written as local time at +05:30."""
    local = ts + F.expr("INTERVAL '5:30' HOUR TO MINUTE")
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))


def _interval(ts, minutes: int) -> Column:
    return F.struct(_iso_z(ts).alias("startTime"),
                    _iso_z(ts + F.expr(f"INTERVAL {minutes} MINUTES")).alias("endTime"))


def _ymd(ts) -> Column:
    return F.struct(F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"))


def _pts(point: Column) -> Column:
    return F.struct(F.array(point).alias("dataPoints"))


def _s(c) -> Column:
    return c.cast("string")


def wearable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of wearable devices with the device timezone."""
    dev = devices(spark, sf_dir).where(F.col("device_type") == "wearable") \
        .select("device_id", "timezone")
    return readings(spark, sf_dir).join(dev, "device_id")


def wearable_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ingests of wearable devices: one JSON payload per event.

    view     -> steps (interval) + active-minutes (list; absent when k%5=0)
    click    -> heart-rate (sample; +05:30 offset when k%3=0)
                + respiratory-rate-sleep-summary (null / absent stage keys)
    purchase -> active-zone-minutes (tag absent when k%4=3) + exercise
                + calories-in-heart-rate-zone (empty dataPoints, civil-date rollup)
    signup   -> daily-oxygen-saturation (date absent when event_id%997=0,
                upper bound null when k even) + daily-heart-rate-variability
                + daily-heart-rate-zones (second zone without type) + profile
    error    -> activity-level + sleep (2 stages) + sedentary-period (dropped)
                + weight (unmapped, k even) + floors (empty) + mystery-metric
                (unrecognised, k%3=0) + distance (null section)
    """
    # Dealt evenly before the payloads are built: a scan gives a task whole row groups, and the device join may broadcast.
    e = wearable_events(spark, sf_dir).repartition("event_id")
    ts, k, v, t = F.col("recorded_at"), F.col("k"), F.col("value"), F.col("data_type")
    jnull = F.lit(_JSON_NULL)
    level = F.element_at(F.array(*[F.lit(x) for x in ["SEDENTARY", "LIGHT", "MODERATE", "VERY"]]),
                         (k % 4 + 1).cast("int"))
    zone = F.when(k % 4 == 0, "FAT_BURN").when(k % 4 == 1, "CARDIO").when(k % 4 == 2, "PEAK")
    date = F.when(F.col("event_id") % 997 != 0, _ymd(ts))
    when = lambda typ, c: F.when(t == typ, c)

    payload = F.struct(
        when("view", _pts(F.struct(F.struct(
            _interval(ts, 1).alias("interval"), _s(k).alias("count")).alias("steps")))).alias("steps"),
        when("view", _pts(F.struct(F.struct(
            _interval(ts, 1).alias("interval"),
            F.when(k % 5 != 0, F.array(
                F.struct(F.lit("LIGHT").alias("activityLevel"), _s(k).alias("activeMinutes")),
                F.struct(F.lit("MODERATE").alias("activityLevel"), _s(v).alias("activeMinutes"))))
            .alias("activeMinutesByActivityLevel")).alias("activeMinutes")))).alias("active-minutes"),
        when("click", _pts(F.struct(F.struct(
            F.struct(F.when(k % 3 == 0, _iso_ist(ts)).otherwise(_iso_z(ts)).alias("physicalTime"))
            .alias("sampleTime"),
            _s(v).alias("beatsPerMinute")).alias("heartRate")))).alias("heart-rate"),
        when("click", _pts(F.struct(F.struct(
            F.struct(_iso_z(ts).alias("physicalTime")).alias("sampleTime"),
            F.struct(v.alias("breathsPerMinute"), (k / 10.0).alias("standardDeviation"),
                     jnull.alias("signalToNoise")).alias("deepSleepStats"),
            F.struct((v + 1).alias("breathsPerMinute")).alias("fullSleepStats"),
            F.struct(F.lit(None).cast("string").alias("absent")).alias("lightSleepStats"))
            .alias("respiratoryRateSleepSummary")))).alias("respiratory-rate-sleep-summary"),
        when("purchase", _pts(F.struct(F.struct(
            _interval(ts, 1).alias("interval"), zone.alias("heartRateZone"),
            _s(k).alias("activeZoneMinutes")).alias("activeZoneMinutes")))).alias("active-zone-minutes"),
        when("purchase", _pts(F.struct(F.struct(
            _interval(ts, 45).alias("interval"), F.lit("WALKING").alias("exerciseType"),
            F.lit("Walk").alias("displayName"),
            F.struct(v.alias("caloriesKcal"), (k * 1000).alias("distanceMillimeters"),
                     _s(k * 10).alias("steps"), F.lit(0.8).alias("averagePaceSecondsPerMeter"),
                     _s(k + 60).alias("averageHeartRateBeatsPerMinute"),
                     F.struct(F.concat(_s(k * 60), F.lit("s")).alias("lightTime"),
                              F.lit("60s").alias("moderateTime")).alias("heartRateZoneDurations"))
            .alias("metricsSummary")).alias("exercise")))).alias("exercise"),
        when("purchase", F.struct(
            F.array().cast("array<string>").alias("dataPoints"),
            F.array(F.struct(
                F.struct(_ymd(ts).alias("date")).alias("civilStartTime"),
                F.struct(F.array(
                    F.struct(F.lit("PEAK").alias("heartRateZone"), v.alias("kcal")),
                    F.struct(F.lit("CARDIO").alias("heartRateZone"), k.cast("double").alias("kcal"))
                ).alias("caloriesInHeartRateZones")).alias("caloriesInHeartRateZone")
            )).alias("rollupDataPoints"))).alias("calories-in-heart-rate-zone"),
        when("signup", _pts(F.struct(F.struct(
            date.alias("date"), v.alias("averagePercentage"), (v - 1).alias("lowerBoundPercentage"),
            F.when(k % 2 == 0, jnull).otherwise(_s(v + 1)).alias("upperBoundPercentage"),
            (k / 10.0).alias("standardDeviationPercentage")).alias("dailyOxygenSaturation"))))
        .alias("daily-oxygen-saturation"),
        when("signup", _pts(F.struct(F.struct(
            _ymd(ts).alias("date"), v.alias("averageHeartRateVariabilityMilliseconds"),
            _s(k).alias("nonRemHeartRateBeatsPerMinute"),
            F.when(k % 3 != 0, k / 7.0).alias("entropy")).alias("dailyHeartRateVariability"))))
        .alias("daily-heart-rate-variability"),
        when("signup", _pts(F.struct(F.struct(
            _ymd(ts).alias("date"),
            F.array(F.struct(F.lit("LIGHT").alias("heartRateZoneType"), F.lit("90").alias("minBeatsPerMinute"),
                             _s(k + 90).alias("maxBeatsPerMinute")),
                    F.struct(F.lit(None).cast("string").alias("heartRateZoneType"),
                             _s(k).alias("minBeatsPerMinute"), jnull.alias("maxBeatsPerMinute")))
            .alias("heartRateZones")).alias("dailyHeartRateZones")))).alias("daily-heart-rate-zones"),
        when("signup", F.struct(
            (F.lit(20) + k % 50).alias("age"),
            F.struct((F.lit(2020) + k % 4).alias("year"), (F.lit(1) + k % 12).alias("month"),
                     F.when(k % 4 != 0, F.lit(1) + k % 28).alias("day")).alias("membershipStartDate"),
            (F.lit(700) + k).alias("userConfiguredWalkingStrideLengthMm"),
            (F.lit(900) + k).alias("userConfiguredRunningStrideLengthMm"))).alias("profile"),
        when("error", _pts(F.struct(F.struct(
            _interval(ts, 1).alias("interval"), level.alias("activityLevelType")).alias("activityLevel"))))
        .alias("activity-level"),
        when("error", _pts(F.struct(F.struct(
            _interval(ts, 480).alias("interval"), F.lit("STAGES").alias("type"),
            F.struct((k % 5 == 0).alias("nap")).alias("metadata"),
            F.struct(F.lit("480").alias("minutesInSleepPeriod"), _s(k % 10).alias("minutesAfterWakeUp"),
                     _s(k % 20).alias("minutesToFallAsleep"), _s(k + 400).alias("minutesAsleep"),
                     _s(80 - k % 80).alias("minutesAwake")).alias("summary"),
            F.array(F.struct(_iso_z(ts).alias("startTime"),
                             _iso_z(ts + F.expr("INTERVAL 60 MINUTES")).alias("endTime"),
                             F.lit("LIGHT").alias("type")),
                    F.struct(_iso_z(ts + F.expr("INTERVAL 60 MINUTES")).alias("startTime"),
                             _iso_z(ts + F.expr("INTERVAL 180 MINUTES")).alias("endTime"),
                             F.lit("DEEP").alias("type"))).alias("stages")).alias("sleep"))))
        .alias("sleep"),
        when("error", _pts(F.struct(F.struct(_interval(ts, 30).alias("interval")).alias("sedentaryPeriod"))))
        .alias("sedentary-period"),
        F.when((t == "error") & (k % 2 == 0), _pts(F.struct(F.struct(
            F.struct(_iso_z(ts).alias("physicalTime")).alias("sampleTime"),
            _s(k * 1000).alias("weightGrams")).alias("weight")))).alias("weight"),
        when("error", F.struct(F.array().cast("array<string>").alias("dataPoints"))).alias("floors"),
        F.when((t == "error") & (k % 3 == 0), _pts(F.struct(F.struct(
            F.lit(None).cast("string").alias("absent")).alias("mysteryMetric")))).alias("mystery-metric"),
        when("error", jnull).alias("distance"),
    )
    text = F.replace(F.to_json(payload), F.lit(f'"{_JSON_NULL}"'), F.lit("null"))
    # Every 17th pull carries an ingest method outside the allowed set.
    method = F.when(k % 17 == 0, F.lit("cron")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in ["api_auto", "api_manual", "test_script"]]),
                     (k % 3 + 1).cast("int")))
    return e.select(F.col("event_id").alias("ingest_id"), F.lit("wearable").alias("device_type"),
                    "device_id", method.alias("ingest_method"),
                    (ts + F.expr("INTERVAL 1 HOUR")).alias("pulled_at"),
                    text.alias("payload"), "timezone")


def air_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of air-sensor devices with timezone and MAC."""
    dev = devices(spark, sf_dir).where(F.col("device_type") == "air") \
        .select("device_id", "timezone", "mac")
    return readings(spark, sf_dir).join(dev, "device_id")


def _coord(device_id, mult: int, span: int, k) -> Column:
    return F.round((device_id * mult % span) - span / 2 + k / 100.0, 4)


def air_record(e_ts="recorded_at") -> Column:
    """One air-sensor record from an event row (see :func:`air_raw`)."""
    ts, k, v = F.col(e_ts), F.col("k"), F.col("value")
    tz = F.col("timezone")
    local = F.from_utc_timestamp(ts.cast("timestamp"), F.coalesce(tz, F.lit("UTC"))).cast("timestamp_ntz")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    date = (F.when(k % 3 == 0, F.concat(F.date_format(ts, fmt), F.lit("Z")))
            .when(k % 3 == 1, F.concat(F.date_format(ts + F.expr("INTERVAL '5:30' HOUR TO MINUTE"), fmt),
                                       F.lit("+05:30")))
            .otherwise(F.date_format(local, fmt)))
    lat = _coord(F.col("device_id"), 1, 170, k)
    lon = _coord(F.col("device_id"), 7, 350, k)
    lat = F.when(k % 10 == 0, F.lit(None)).when(k % 10 == 1, F.lit(0.0)).when(k % 10 == 2, F.lit(0.0)) \
        .otherwise(lat)
    lon = F.when(k % 10 == 1, F.lit(0.0)).otherwise(lon)
    fields = [
        ("date", date), ("lat", lat.cast("double")), ("lon", lon.cast("double")), ("aqs", k),
        ("pm05_num", F.when(k % 4 != 0, k * 10)), ("pm1_num", k * 5), ("pm10_num", k * 2),
        ("pm25_num", k * 3), ("voc_index", k + 1), ("nox_index", k + 2), ("co2", F.lit(400) + k),
        ("battery", F.lit(100) - k), ("altitude", F.lit(10) + k), ("position_error", k % 7),
        ("satellites_fixed", F.when(k % 5 != 0, k % 12)), ("satellites_in_view", k % 12 + 3),
        ("pm1", v / 3), ("pm25", v), ("pm10", v * 1.5), ("pm_size", F.when(k % 6 != 0, k / 100.0)),
        ("t", v / 10), ("h", k.cast("double")), ("p", F.lit(1000.0) + k / 10.0), ("voc", k / 1000.0),
        ("charging", k % 3 == 0), ("recently_charged", k % 3 == 1), ("motion", k % 2 == 0)]
    return F.named_struct(*[x for name, c in fields for x in (F.lit(name), c)])


# Air payloads hold at most this many records (bounded payload size).
AIR_BATCH = 64


def air_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ingests of air devices: payload ``{mac, merged_data:[record]}`` of
    up to 64 records per (device, event_id // 64) -- a bounded group. Dates
    are written with 'Z', '+05:30' or as offset-less local time; coordinates
    include missing, (0,0) and one-axis-zero cases; every 13th record is
    repeated identically. Every 11th device reports a MAC unknown to the
    registry."""
    e = air_events(spark, sf_dir)
    rec = air_record()
    copies = F.when(F.col("k") % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = e.select("device_id", "timezone", "mac", "event_id", "recorded_at",
                    (F.col("event_id") / AIR_BATCH).cast("long").alias("_batch"),
                    F.explode(copies).alias("_copy"), rec.alias("rec"))
    g = rows.groupBy("device_id", "_batch").agg(
        F.first("timezone").alias("timezone"), F.first("mac").alias("mac"),
        F.min("event_id").alias("ingest_id"), F.max("recorded_at").alias("_last"),
        F.sort_array(F.collect_list(F.struct("recorded_at", "event_id", "_copy", "rec"))).alias("_recs"))
    mac = F.when(F.col("device_id") % 11 == 0, F.concat(F.lit("FF:"), F.substring("mac", 4, 14))) \
        .otherwise(F.col("mac"))
    payload = F.to_json(F.struct(mac.alias("mac"),
                                 F.transform("_recs", lambda x: x["rec"]).alias("merged_data")))
    return g.select("ingest_id", F.lit("air").alias("device_type"), "device_id",
                    F.lit("api_auto").alias("ingest_method"),
                    (F.col("_last") + F.expr("INTERVAL 1 HOUR")).alias("pulled_at"),
                    payload.alias("payload"), "timezone")


def pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ingests of both device types, landed once for the query that reads
    them several times. Air payloads whose ingest id divides by 41 arrived
    cut short: they are no JSON."""
    air = air_raw(spark, sf_dir)
    cut = F.when(F.col("ingest_id") % 41 == 0, F.substring("payload", 1, 20)).otherwise(F.col("payload"))
    wear = wearable_raw(spark, sf_dir)
    return materialize(spark, wear.unionByName(air.withColumn("payload", cut)).select(*wear.columns), "pulls")


# The air sensor's CSV export header, in export order.
CSV_HEADER = ["Date (UTC+05:30)", "AQS", "PM1.0 (µg/m³)", "PM2.5 (µg/m³)", "PM10 (µg/m³)",
              "Temperature (°C)", "Humidity (%)", "Pressure (hPa)", "TVOC Index", "TVOC (ppm)",
              "NOx Index", "CO2 (ppm)", "Latitude", "Longitude", "Altitude (m)", "Position Error (m)",
              "Battery (%)", "Charging", "Motion", "User Notes"]

# Files hold at most this many rows (bounded file size).
CSV_BATCH = 256


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV exports of air devices as (file_name, content), built from events.

    One file per (device, event_id // 256), named ``<MAC>_<first>_<last>.csv``
    (every 9th device's files are misnamed ``export_<id>.csv``); odd devices
    export Latitude/Longitude in swapped column order. Rows carry local
    +05:30 time to the second; PM10 blank when k%8=0, temperature 'nan' when
    k%9=0, humidity 'n/a' when k%11=0; notes with commas when k%4=0; short
    rows (last 3 cells missing) when k%19=0; a blank line after k%23=0.
    A re-export ``..._v2.csv`` repeats rows with k%29=0 identically and rows
    with k%31=0 with PM2.5 + 1 (a conflict).
    """
    e = air_events(spark, sf_dir)
    ts, k, v = F.col("recorded_at"), F.col("k"), F.col("value")
    rec = air_record()
    local = F.date_format(ts + F.expr("INTERVAL '5:30' HOUR TO MINUTE"), "yyyy-MM-dd HH:mm:ss")
    num = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    charging = F.when(k % 3 == 0, "yes").when(k % 3 == 1, "cd").otherwise("no")
    swapped = F.col("device_id") % 2 == 1

    def line(pm25):
        lat, lon = num(rec["lat"]), num(rec["lon"])
        cells = [local, num(k), num(v / 3), num(pm25), F.when(k % 8 == 0, "").otherwise(num(v * 1.5)),
                 F.when(k % 9 == 0, "nan").otherwise(num(v / 10)),
                 F.when(k % 11 == 0, "n/a").otherwise(num(k.cast("double"))),
                 num(F.lit(1000.0) + k / 10.0), num(k + 1), num(k / 1000.0), num(k + 2), num(F.lit(400) + k),
                 F.when(swapped, lon).otherwise(lat), F.when(swapped, lat).otherwise(lon),
                 num(F.lit(10) + k), num(k % 7), num(F.lit(100) - k)]
        tail = [charging, F.when(k % 2 == 0, "yes").otherwise("no"),
                F.when(k % 4 == 0, "checked, ok, moved").otherwise("")]
        full = F.concat_ws(",", *cells, *tail)
        short = F.concat_ws(",", *cells)
        body = F.when(k % 19 == 0, short).otherwise(full)
        return F.when(k % 23 == 0, F.concat(body, F.lit("\n"))).otherwise(body)

    batch = (F.col("event_id") / CSV_BATCH).cast("long")
    main = e.select("device_id", "mac", batch.alias("_b"), F.lit("").alias("_v"), "recorded_at",
                    line(v).alias("_line"))
    again = e.where((k % 29 == 0) | (k % 31 == 0)).select(
        "device_id", "mac", batch.alias("_b"), F.lit("_v2").alias("_v"), "recorded_at",
        line(F.when(k % 31 == 0, v + 1).otherwise(v)).alias("_line"))
    rows = main.unionByName(again)
    g = rows.groupBy("device_id", "mac", "_b", "_v").agg(
        F.min("recorded_at").alias("_t0"), F.max("recorded_at").alias("_t1"),
        F.sort_array(F.collect_list(F.struct("recorded_at", "_line"))).alias("_rows"))
    hdr = lambda order: "\ufeff" + ",".join(order)
    swapped_hdr = list(CSV_HEADER)
    i, j = swapped_hdr.index("Latitude"), swapped_hdr.index("Longitude")
    swapped_hdr[i], swapped_hdr[j] = swapped_hdr[j], swapped_hdr[i]
    header = F.when(F.col("device_id") % 2 == 1, F.lit(hdr(swapped_hdr))).otherwise(F.lit(hdr(CSV_HEADER)))
    mac12 = F.regexp_replace("mac", ":", "")
    name = F.when(F.col("device_id") % 9 == 0,
                  F.concat(F.lit("export_"), F.col("device_id").cast("string"), F.lit("_"), F.col("_b").cast("string"),
                           F.col("_v"), F.lit(".csv"))) \
        .otherwise(F.concat(mac12, F.lit("_"), F.date_format("_t0", "dd-MMM-yyyy"), F.lit("_"),
                            F.date_format("_t1", "dd-MMM-yyyy"), F.lit("_p"), F.col("_b").cast("string"),
                            F.col("_v"), F.lit(".csv")))
    content = F.concat(header, F.lit("\n"), F.concat_ws("\n", F.transform("_rows", lambda r: r["_line"])))
    return g.select(name.alias("file_name"), content.alias("content"))


# Registry documents hold at most this many devices (bounded document size).
REGISTRY_BATCH = 100


def device_registry_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device registry documents, as the study's config files hold them:
    ``{"wearable_devices": [..], "air_devices": [..], "version": ..}`` per
    (site, custkey // 100). Every 97th entry lacks its id (malformed); every
    5th writes its start date under the key ``Start_date``; every 4th has no
    start date."""
    d = devices(spark, sf_dir)
    start = F.when(F.col("device_id") % 4 != 0,
                   F.date_add(F.lit("2024-01-01").cast("date"), (F.col("device_id") % 7).cast("int")))
    entry = F.to_json(F.struct(
        F.when(F.col("device_id") % 97 != 0, F.col("device_id").cast("string")).alias("id"),
        F.col("device_type").alias("type"), "site", "timezone",
        F.when(F.col("device_id") % 5 != 0, start.cast("string")).alias("start_date"),
        F.when(F.col("device_id") % 5 == 0, start.cast("string")).alias("Start_date"),
        F.col("mac").alias("mac")))
    g = d.groupBy("site", (F.col("device_id") / REGISTRY_BATCH).cast("long").alias("_b")).agg(
        F.collect_list(F.when(F.col("device_type") == "wearable", entry)).alias("w"),
        F.collect_list(F.when(F.col("device_type") == "air", entry)).alias("a"))
    doc = F.concat(F.lit('{"version": 1, "wearable_devices": ['), F.array_join("w", ","),
                   F.lit('], "air_devices": ['), F.array_join("a", ","), F.lit("]}"))
    return g.select(F.concat_ws("-", "site", "_b").alias("doc_id"), doc.alias("doc"))


def participant_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participant registry documents with nested device assignments."""
    a = assignments(spark, sf_dir)
    g = a.groupBy("participant_id").agg(
        F.min("assigned_from").alias("enrolled_at"),
        F.collect_list(F.struct(F.col("device_id").cast("string").alias("device_id"),
                                F.col("assigned_from").cast("string").alias("assigned_from"),
                                F.col("assigned_until").cast("string").alias("assigned_until")))
        .alias("device_assignments"))
    return g.select("participant_id", F.to_json(F.struct(
        F.col("participant_id").alias("id"), F.col("enrolled_at").cast("string").alias("enrolled_at"),
        "device_assignments"), {"ignoreNullFields": "false"}).alias("doc"))


def legacy_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy multi-sensor export rows of air devices: ``timestamp`` (ISO,
    'Z'), ``device`` and a JSON blob ``data`` with nested sensor groups
    (pm / dht / bme / gas / gps / sys / net). Every 50th blob is not JSON."""
    e = air_events(spark, sf_dir)
    rec = air_record()
    k, v = F.col("k"), F.col("value")
    blob = F.to_json(F.struct(
        F.struct((v / 3).alias("pm1_0_atm_ug_m3"), v.alias("pm2_5_atm_ug_m3"),
                 (v * 1.5).alias("pm10_atm_ug_m3"), (k * 7).alias("pm0_3_um_count"),
                 (k * 3).alias("pm2_5_um_count"), (k * 2).alias("pm10_um_count"),
                 (v * 1.1).alias("pm2_5_cf1")).alias("pm"),
        F.struct((v / 10).alias("temp_c"), k.alias("hum_pct")).alias("dht"),
        F.struct((F.lit(1000.0) + k / 10.0).alias("press_hpa")).alias("bme"),
        F.struct((k / 1000.0).alias("tvoc_ppm"), (k + 2).alias("nox_index")).alias("gas"),
        F.struct(rec["lat"].alias("lat"), rec["lon"].alias("lon"), (F.lit(10) + k).alias("alt_m"),
                 (k % 12 + 3).alias("sat_view"), (k % 12).alias("sat_fix"),
                 (k % 7).alias("position_err")).alias("gps"),
        F.struct((k / 2.0).alias("cpu_pct"), (F.lit(40.0) + k / 10.0).alias("cpu_temp"),
                 (k / 100.0).alias("load_1"), F.lit(512).alias("mem_total")).alias("sys"),
        F.struct(F.concat(F.lit("10.0.0."), (F.col("device_id") % 250).cast("string")).alias("local_ip"))
        .alias("net")), {"ignoreNullFields": "false"})
    return e.select(
        F.concat(F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("timestamp"),
        F.col("device_id").cast("string").alias("device"),
        F.when(k % 50 == 0, F.lit("not json")).otherwise(blob).alias("data"))

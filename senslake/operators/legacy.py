"""Legacy multi-sensor export: detection and sub-table split (SRC8,
AGG15-17, JN9, PRJ27-33, PRJ38).

Detection operators run one distributed aggregate and collect a single
summary row to the driver (they choose column names at plan time); the data
itself never passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from senslake.functions.text import keyword_columns, keyword_renames
from senslake.operators.filters import valid_coordinates
from senslake.operators.joins import maybe_broadcast

# ---------------------------------------------------------------------------
# Keyword rules of the legacy sub-tables. Each table is
# (include keywords, exclude keywords, [(all-of keywords, new name), ...]).
# Keywords are case-insensitive; include/exclude keywords are regexes.
# ---------------------------------------------------------------------------
PM_MASS = (["datetime", "pm.pm", "atm", "ug", "m3"], ["cf", "count", "um", "ppm"],
           [(["pm", "2", "5"], "pm2_5_ugm3_atm"), (["pm", "10"], "pm10_ugm3_atm"),
            (["pm", "1"], "pm1_0_ugm3_atm")])
PM_COUNT = (["datetime", "pm.pm", "count", "um"], ["atm", "ug", "m3", "cf", "ppm", "hum"],
            [(["0", "3"], "pm0_3_um_count"), (["0", "5"], "pm0_5_um_count"), (["2", "5"], "pm2_5_um_count"),
             (["10"], "pm10_um_count"), (["1"], "pm1_0_um_count"), (["5"], "pm5_0_um_count")])
PM_CF = (["datetime", "pm.pm", "cf"], ["atm", "ug", "m3", "count", "um", "ppm"],
         [(["0", "5"], "pm0_5_ugm3_cf"), (["2", "5"], "pm2_5_ugm3_cf"), (["10"], "pm10_ugm3_cf"),
          (["1"], "pm1_0_ugm3_cf")])
WEATHER = (["datetime", "temp", "hum", "press"], ["net", "sys", "power", "errors"],
           [(["temp"], "temp_c"), (["hum"], "hum_pct"), (["press"], "press_hpa")])
GAS = (["datetime", "tvoc", "nox", "co2"], [],
       [(["tvoc", "ppm"], "tvoc_ppm"), (["tvoc", "index"], "tvoc_index"), (["nox", "index"], "nox_index"),
        (["co2", "ppm"], "co2_ppm")])
SAT = (["datetime", "sat", "position"], ["net", "sys", "power", "errors"],
       [(["position"], "position_error_m"), (["sat", "view"], "sat_view_count"),
        (["sat", "fix"], "sat_used_count")])
SYS = (["datetime", "sys", "power"], ["net", "dht", "gps", "pm", "errors"],
       [(["cpu", "pct"], "cpu_pct"), (["cpu", "temp"], "cpu_temp_c"), (["load", "1"], "load_1min"),
        (["load", "5"], "load_5min"), (["load", "15"], "load_15min"), (["mem", "total"], "mem_total_mb"),
        (["mem", "avail"], "mem_avail_mb"), (["mem", "used"], "mem_used_mb"), (["uptime"], "uptime_s"),
        (["vcore"], "vcore_v"), (["vsdram", "c"], "vsdram_c_v"), (["vsdram", "i"], "vsdram_i_v"),
        (["vsdram", "p"], "vsdram_p_v"), (["undervolt", "now"], "undervolt_now_bool"),
        (["freq", "capped", "now"], "freq_capped_now_bool"), (["throttled", "now"], "throttled_now_bool"),
        (["soft", "temp", "now"], "soft_temp_now_bool"), (["undervolt", "occurred"], "undervolt_occurred_bool"),
        (["freq", "capped", "occurred"], "freq_capped_occurred_bool"),
        (["throttled", "occurred"], "throttled_occurred_bool"),
        (["soft", "temp", "occurred"], "soft_temp_occurred_bool")])
NET = (["datetime", "net"], [], [(["local"], "local_ip"), (["public"], "public_ip")])
GIS = (["datetime", "timezone", "latitude", "longitude", "alt"], [], [(["alt"], "altitude")])

# Detection keywords and patterns.
TIME_NAME_KEYWORDS = ["time", "date", "datetime", "timestamp", "ts"]
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}"
TZ_AWARE_PATTERN = r"(\+\d{2}:\d{2}|Z|UTC)$"
LAT_KEYWORDS = ["lat", "latitude"]
LON_KEYWORDS = ["lon", "lng", "longitude"]


def _q(c: str):
    return F.col(f"`{c}`")


def json_column_shares(df: DataFrame) -> DataFrame:
    """AGG15: per string column, share of non-null values that parse as a
    JSON object/array (one optional surrounding quote pair removed), over all rows."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]

    def is_json(c):
        v = F.trim(_q(c))
        v = F.when(v.rlike(r'^(".*"|\'.*\')$') & (F.length(v) >= 2),
                   F.trim(F.expr(f"substring(trim(`{c}`), 2, length(trim(`{c}`)) - 2)"))).otherwise(v)
        parsed = F.try_parse_json(v)
        return (v.startswith("{") | v.startswith("[")) & parsed.isNotNull()

    aggs = []
    for c in cols:
        aggs += [F.count(_q(c)).alias(f"{c}__n"), F.count(F.when(is_json(c), 1)).alias(f"{c}__j")]
    row = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__n`, `{c}__j`" for c in cols)
    return row.selectExpr(f"stack({len(cols)}, {stack}) AS (column, non_null, json_values)") \
        .withColumn("is_json", F.col("json_values") > F.col("non_null") * 0.5)


def detect_json_column(df: DataFrame) -> str | None:
    rows = json_column_shares(df).collect()
    order = {c: i for i, c in enumerate(df.columns)}
    hits = sorted((order[r.column], r.column) for r in rows if r.is_json and r.non_null > 0)
    return hits[0][1] if hits else None


def expand_json(df: DataFrame, json_col: str, keep=None) -> DataFrame:
    """SRC8 + SCL8 + SCL9: parse the JSON column safely (bad JSON -> empty),
    infer the leaf schema with one aggregate over the whole column, and add
    one column per leaf named by its dotted path."""
    v = F.try_parse_json(F.trim(_q(json_col)))
    schema = df.select(F.schema_of_variant_agg(v).alias("s")).first()["s"]
    leaves = _leaves(schema)
    keep = [c for c in df.columns if c != json_col] if keep is None else list(keep)
    cols = [F.try_variant_get(v, "$." + ".".join(f"['{p}']" if not p.isidentifier() else p for p in path)
                              .replace(".[", "["), typ).alias(".".join(path))
            for path, typ in leaves]
    return df.select(*[_q(c) for c in keep], *cols)


def _leaves(schema: str):
    """Walk a ``schema_of_variant_agg`` string: OBJECT<a: BIGINT, b: OBJECT<...>>."""
    dt = T._parse_datatype_string(schema.replace("OBJECT<", "STRUCT<")) if schema.startswith("OBJECT") \
        else None
    out = []

    def walk(t, prefix):
        if isinstance(t, T.StructType):
            for f in t.fields:
                walk(f.dataType, prefix + (f.name,))
        else:
            typ = "string" if isinstance(t, (T.ArrayType, T.MapType)) or t.typeName() == "variant" \
                else ("double" if isinstance(t, T.DecimalType) else t.simpleString())
            out.append((prefix, typ))
    if dt is not None:
        walk(dt, ())
    return out


def time_column_scores(df: DataFrame) -> DataFrame:
    """AGG16: legitimacy score per candidate time column: +1 for a time-ish
    name; native timestamps +5 + fill rate; strings: 3 x ISO share + 2 x
    zone-suffix share + fill rate (only if any value looks ISO)."""
    aggs, meta = [F.count("*").alias("__rows")], []
    for f in df.schema.fields:
        c, name = f.name, f.name.lower()
        name_pts = 1.0 if any(k in name for k in TIME_NAME_KEYWORDS) else 0.0
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            aggs.append(F.count(_q(c)).alias(f"{c}__n"))
            meta.append((c, "native", name_pts))
        elif isinstance(f.dataType, T.StringType):
            s = F.trim(_q(c))
            aggs += [F.count(_q(c)).alias(f"{c}__n"),
                     F.count(F.when(s.rlike(ISO_PATTERN), 1)).alias(f"{c}__iso"),
                     F.count(F.when(s.rlike(TZ_AWARE_PATTERN), 1)).alias(f"{c}__tz")]
            meta.append((c, "string", name_pts))
    r = df.agg(*aggs).first()
    rows = []
    total = r["__rows"] or 1
    for c, kind, name_pts in meta:
        n = r[f"{c}__n"]
        fill = n / total
        if kind == "native":
            rows.append((c, name_pts + 5 + fill))
        elif r[f"{c}__iso"] > 0 and n:
            rows.append((c, name_pts + 3 * r[f"{c}__iso"] / n + 2 * r[f"{c}__tz"] / n + fill))
    return df.sparkSession.createDataFrame(rows, "column string, score double")


def latlon_columns(df: DataFrame) -> tuple[str | None, str | None]:
    """AGG17: numeric columns named like lat / lon whose values lie in
    [-90, 90] / [-180, 180] (one min/max aggregate)."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    lat_c = [c for c in num if any(k in c.lower() for k in LAT_KEYWORDS)]
    lon_c = [c for c in num if any(k in c.lower() for k in LON_KEYWORDS)]
    cands = list(dict.fromkeys(lat_c + lon_c))
    if not cands:
        return None, None
    r = df.agg(*[x for c in cands for x in (F.min(_q(c)).alias(f"{c}__lo"), F.max(_q(c)).alias(f"{c}__hi"))]).first()
    ok = lambda c, b: r[f"{c}__lo"] is not None and -b <= r[f"{c}__lo"] and r[f"{c}__hi"] <= b
    lat = next((c for c in lat_c if ok(c, 90)), None)
    lon = next((c for c in lon_c if ok(c, 180)), None)
    return lat, lon


def grid_timezones(points: DataFrame, lat: str = "latitude", lon: str = "longitude",
                   tz: str = "timezone", cell_deg: float = 1.0) -> DataFrame:
    """JN9 lookup table: (cell_lat, cell_lon) -> the most frequent timezone
    among points with a known zone (ties -> smallest name). Its size is
    bounded by the number of grid cells, not by the data."""
    cell = [F.floor(F.col(lat) / cell_deg).alias("cell_lat"), F.floor(F.col(lon) / cell_deg).alias("cell_lon")]
    known = points.where(F.col(tz).isNotNull() & valid_coordinates(F.col(lat), F.col(lon)))
    counts = known.groupBy(*cell, F.col(tz).alias("tz")).agg(F.count("*").alias("n"))
    return counts.groupBy("cell_lat", "cell_lon").agg(
        F.min_by("tz", F.struct(-F.col("n"), F.col("tz"))).alias("timezone"))


def attach_timezone(df: DataFrame, cells: DataFrame, lat: str = "latitude", lon: str = "longitude",
                    cell_deg: float = 1.0, strict: bool = False) -> DataFrame:
    """JN9: timezone by coordinates -- grid-cell equi-join against a lookup
    table (broadcast only under the size limit). Rows without valid
    coordinates get null."""
    ok = valid_coordinates(F.col(lat), F.col(lon), either_zero=strict)
    keyed = df.withColumn("cell_lat", F.when(ok, F.floor(F.col(lat) / cell_deg))) \
        .withColumn("cell_lon", F.when(ok, F.floor(F.col(lon) / cell_deg)))
    return keyed.join(maybe_broadcast(cells), ["cell_lat", "cell_lon"], "left").drop("cell_lat", "cell_lon")


def sub_table(df: DataFrame, rule, keys=("device",)) -> DataFrame:
    """PRJ27 + PRJ28: keyword select, then sequential keyword renames."""
    include, exclude, renames = rule
    cols = keyword_columns([c for c in df.columns if c not in keys], include, exclude)
    mapping = keyword_renames(cols, renames)
    return df.select(*[_q(k) for k in keys], *[_q(c).alias(mapping.get(c, c)) for c in cols])


def pm_table(df: DataFrame, keys=("device",)) -> DataFrame:
    """PRJ29 (+JN4): mass, count and CF=1 groups. All three come from the
    same rows, so they are one projection instead of two left joins on
    datetime (which would multiply rows on repeated timestamps)."""
    src = [c for c in df.columns if c not in keys]
    out, seen = [], set()
    for include, exclude, renames in (PM_MASS, PM_COUNT, PM_CF):
        cols = keyword_columns(src, include, exclude)
        mapping = keyword_renames(cols, renames)
        for c in cols:
            name = mapping.get(c, c)
            if name not in seen:
                seen.add(name)
                out.append(_q(c).alias(name))
    return df.select(*[_q(k) for k in keys], *out)


def standardize(df: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Detect and expand a JSON-blob column, pick the best time column as
    ``datetime`` (UTC), detect lat/lon and attach a timezone."""
    from senslake.functions.time import iso_to_utc

    jc = detect_json_column(df)
    if jc is not None:
        df = expand_json(df, jc)
    scores = time_column_scores(df).collect()
    if not scores:
        raise ValueError("no datetime column detected")
    best = max(scores, key=lambda r: r.score).column
    dt_type = df.schema[best].dataType
    dt = _q(best).cast("timestamp_ntz") if not isinstance(dt_type, T.StringType) else iso_to_utc(_q(best))
    df = df.withColumn(best, dt).withColumnRenamed(best, "datetime")
    lat, lon = latlon_columns(df)
    if lat and lat != "latitude":
        df = df.withColumnRenamed(lat, "latitude")
    if lon and lon != "longitude":
        df = df.withColumnRenamed(lon, "longitude")
    if cells is not None and lat and lon:
        df = attach_timezone(df, cells)
    else:
        df = df.withColumn("timezone", F.lit(None).cast("string"))
    first = [c for c in ["datetime", "longitude", "latitude", "timezone"] if c in df.columns]
    return df.select(*[_q(c) for c in first], *[_q(c) for c in df.columns if c not in first])


def split_tables(std: DataFrame, keys=("device",)) -> dict:
    """PRJ33: one standardised frame -> gis, pm, weather, gas, sat, sys, net."""
    return {"gis": sub_table(std, GIS, keys), "pm": pm_table(std, keys),
            "weather": sub_table(std, WEATHER, keys), "gas": sub_table(std, GAS, keys),
            "sat": sub_table(std, SAT, keys), "sys": sub_table(std, SYS, keys),
            "net": sub_table(std, NET, keys)}

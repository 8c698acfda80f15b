"""Loose CSV exports of the air sensor (SRC3, SRC4, PRJ22-26, SCL3).

The export's last column is free text with unescaped commas, so a CSV
parser cannot split it. We read plain lines and split each on the first
``n_columns - 1`` commas, where ``n_columns`` comes from that file's header.

Line-level design: files are read as lines (``spark.read.text``, with the
file name from ``_metadata``), the header of each file is recognised by its
content (a ``Date (UTC...`` cell) and joined back by file name -- no file is
ever held whole by one task, and files are processed in parallel line by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from senslake.functions.time import header_offset_minutes
from senslake.operators.air import charging_state, motion_flag, to_number
from senslake.operators.joins import maybe_broadcast
from senslake.registry import AIR_REGISTRY, CSV_ALWAYS_NULL, CSV_COLUMNS

FILE_RE = r"^([A-Fa-f0-9]{12})_.*\.csv$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line) for every line of every file under ``path``."""
    t = spark.read.text(path)
    return t.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line"))


def lines_of(files: DataFrame, content: str = "content") -> DataFrame:
    """(file_name, line) from whole-text rows (``read.text(wholetext=True)``
    or contents built in a query)."""
    return files.select("file_name", F.explode(F.split(F.col(content), r"\r?\n")).alias("line"))


def file_metadata(file_names: DataFrame) -> DataFrame:
    """SRC4: MAC from '<12 hex>_*.csv'; non-matching files are 'unmatched'."""
    mac = F.upper(F.regexp_extract("file_name", FILE_RE, 1))
    return file_names.select("file_name",
                             F.when(mac != "", mac).alias("mac"),
                             F.when(mac != "", "matched").otherwise("unmatched").alias("status"))


def _strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, r"^\x{FEFF}", "")


def is_header(line: Column) -> Column:
    """The date column may stand anywhere. A line that does not begin with it is a header only if it also holds another
    column name of the export, so a note that quotes the date column is data."""
    known = F.array(*[F.lit(name) for name in CSV_COLUMNS])
    anywhere = line.rlike(r"(^|,)\s*Date \(UTC") & F.arrays_overlap(F.split(F.trim(line), r"\s*,\s*"), known)
    return F.trim(line).startswith("Date (UTC") | anywhere


def rejected_files(lines: DataFrame) -> DataFrame:
    """(file_name, reason): files without a recognised header. Their lines are not loaded, but reported here."""
    found = F.max(is_header(_strip_bom(F.col("line"))))
    return (lines.groupBy("file_name").agg(found.alias("ok")).where(~F.coalesce("ok", F.lit(False)))
            .select("file_name", F.lit("no date header").alias("reason")))


def headers(lines: DataFrame) -> DataFrame:
    """One header per file: cells, column count, date column index (PRJ23)
    and the UTC offset it declares (minutes)."""
    h = (lines.select("file_name", _strip_bom(F.col("line")).alias("line"))
         .where(is_header(F.col("line")))
         .groupBy("file_name").agg(F.min("line").alias("header_line")))
    cells = F.split("header_line", ",")
    date_idx = F.array_position(F.transform(cells, lambda c: F.trim(c).startswith("Date (UTC")), True)
    return h.select("file_name", cells.alias("header"), F.size(cells).alias("n_cols"),
                    date_idx.alias("date_idx"),
                    header_offset_minutes(F.element_at(cells, date_idx.cast("int"))).alias("offset_min"))


def split_rows(lines: DataFrame) -> DataFrame:
    """Data lines split into exactly ``n_cols`` cells: the last cell keeps
    any extra commas; short rows are padded with ''; blank lines skipped."""
    h = headers(lines)
    data = (lines.select("file_name", _strip_bom(F.col("line")).alias("line"))
            .where(~is_header(F.col("line")) & (F.trim("line") != "")))
    j = data.join(maybe_broadcast(h), "file_name")
    raw = F.split(F.col("line"), ",", F.col("n_cols"))
    pad = F.array_repeat(F.lit(""), F.greatest(F.col("n_cols") - F.size(raw), F.lit(0)))
    return j.select("file_name", "header", "date_idx", "offset_min",
                    F.concat(raw, pad).alias("cells"), F.size(raw).alias("n_found"))


def cell(name: str) -> Column:
    """PRJ22: a cell by header name (exact), '' when the column is absent."""
    pos = F.array_position(F.col("header"), F.lit(name))
    return F.when(pos > 0, F.element_at("cells", pos.cast("int")))


def to_records(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows -> air records with true UTC times (SCL3 via the header offset,
    D4) and typed values (PRJ24-26); ``keep`` carries columns of ``rows`` along."""
    local = F.try_to_timestamp(F.trim(F.element_at("cells", F.col("date_idx").cast("int"))))
    utc = (local.cast("timestamp_ntz")
           - F.make_dt_interval(F.lit(0), F.lit(0), F.col("offset_min"), F.lit(0)))
    charging, recent = charging_state(cell("Charging"))
    out = [F.col("file_name"), *keep, utc.alias("recorded_at")]
    typed = {}
    for header, key in CSV_COLUMNS.items():
        typed[key] = to_number(cell(header))
    for key, (name, typ, _) in AIR_REGISTRY.items():
        if key in typed:
            v = typed[key]
            v = F.round(v).cast("int") if typ == "int" else v.cast(typ)
            out.append(v.alias(name))
        elif key in CSV_ALWAYS_NULL:
            out.append(F.lit(None).cast(typ).alias(name))
    out += [F.lit(None).cast("double").alias(key) for key in CSV_ALWAYS_NULL if key not in AIR_REGISTRY]
    out += [charging.alias("charging"), recent.alias("recently_charged"),
            motion_flag(cell("Motion")).alias("motion"),
            typed["lat"].alias("latitude"), typed["lon"].alias("longitude")]
    return rows.select(*out)


def file_start(name: Column) -> Column:
    """The start date in an export's name (``<MAC>_<start>_<end>...``), null without one."""
    return F.try_to_timestamp(F.regexp_extract(name, r"^[^_]*_(\d{2}-[A-Za-z]{3}-\d{4})(_|\.)", 1), F.lit("dd-MMM-yyyy")).cast("date")

"""Export files as a Spark data source, batch and streaming (SRC3, PRJ23).

A partition is a byte range of a long file, or several short files: a range owns the lines that begin in it and reads its
file's first line for the header, so a file of any size spreads over tasks and no row is joined back to its header. Millions of short files
come in tar archives (``sinks.files.write_archives``): an archive is read whole by one task, its members as if they lay in the folder. Splitting and typing stay in
columns (``rows``, then ``csv_export.to_records``); Python only finds line ends.
"""

from __future__ import annotations

import json
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from senslake.functions.time import header_offset_minutes
from senslake.operators.joins import maybe_broadcast
from senslake.registry import CSV_COLUMNS
from senslake.sources.csv_export import FILE_RE, is_header, to_records

FORMAT = "senslake_exports"
SCHEMA = "file_name string, position long, header_line string, line string"
#: Bytes of one partition, of one read, and lines (and about their bytes) of one Arrow batch.
RANGE, READ, BATCH, BATCH_BYTES = 64 << 20, 1 << 20, 8192, 8 << 20
#: Files that one task reads at most, and the suffix of archives.
FILES, ARCHIVE = 1024, ".tar"
_ARROW = pa.schema([("file_name", pa.string()), ("position", pa.int64()), ("header_line", pa.string()), ("line", pa.string())])
_DATE = re.compile(r"(^|,)\s*Date \(UTC")


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (``file:/x`` included), and the path in it."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _files(path: str, suffix: str) -> list[tuple[str, int]]:
    """(path, size) of the exports and archives in a folder, or of the one file named; hidden and unfinished ones left out."""
    store, base = filesystem(path)
    info = store.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(base))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name.endswith((suffix, ARCHIVE)) and f.base_name[0] not in "._")


def _is_header(line: str) -> bool:
    """The rule of ``csv_export.is_header`` for one line."""
    return line.strip(" ").startswith("Date (UTC") or bool(_DATE.search(line)) and any(c.strip() in CSV_COLUMNS for c in line.split(","))


def _text(line: bytes, first: bool) -> str:
    text = (line[:-1] if line.endswith(b"\r") else line).decode("utf-8", "replace")
    return text[1:] if first and text.startswith("﻿") else text


def _lines(handle, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(position, line) of the lines that begin in [start, end); the last may run on past ``end``."""
    # a line begins where the byte before it is a line end
    handle.seek(max(0, start - 1))
    at, rest, skip = handle.tell(), [], start > 0
    while True:
        chunk = handle.read(READ)
        parts = chunk.split(b"\n")
        for part in parts[:-1]:
            line = b"".join([*rest, part])
            rest = []
            if not skip:
                if at >= end:
                    return
                yield at, line
            skip = False
            at += len(line) + 1
        rest.append(parts[-1])
        if not chunk:
            line = b"".join(rest)
            if line and not skip and at < end:
                yield at, line
            return
        if at >= end and not skip:
            return


def _header(handle) -> tuple[int, str | None]:
    """Position of the first line that is not blank, and its text if it is a header."""
    for at, line in _lines(handle, 0, 1 << 62):
        text = _text(line, at == 0)
        if text.strip():
            return at, text if _is_header(text) else None
    return -1, None


class FileRanges(InputPartition):
    """(path, start, end) of the ranges that one task reads."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        super().__init__(tuple(ranges))


def _ranges(files: list[tuple[str, int]], width: int) -> list[FileRanges]:
    """Long files cut at ``width`` bytes, archives never; short ones share a task, ``FILES`` at most."""
    out, size = [], width
    for path, length in files:
        piece = max(width, length) if path.endswith(ARCHIVE) else width
        for at in range(0, max(length, 1), piece):
            cost = min(piece, length - at) + width // FILES
            if not out or size + cost > width + width // FILES:
                out.append([])
                size = 0
            out[-1].append((path, at, min(at + piece, length)))
            size += cost
    return [FileRanges(r) for r in out]


class _Reads:
    """Reads file ranges; the base folder's URI names the file system."""

    def __init__(self, options):
        self.base, self.width = options["path"], int(options.get("rangebytes", RANGE))
        self.suffix = options.get("suffix", ".csv")

    def read(self, partition: FileRanges) -> Iterator[pa.RecordBatch]:
        # Lines of many short files share a batch.
        rows, size = [], 0
        for row in self._rows(partition):
            rows.append(row)
            size += len(row[3] or "") + len(row[2] or "")
            if len(rows) == BATCH or size >= BATCH_BYTES:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _rows(self, partition: FileRanges) -> Iterator[tuple]:
        store, _ = filesystem(self.base)
        for path, start, end in partition.value:
            with store.open_input_file(path) as handle:
                if path.endswith(ARCHIVE):
                    yield from self._members(handle)
                else:
                    yield from _range(path.rsplit("/", 1)[-1], handle, start, end)

    def _members(self, handle) -> Iterator[tuple]:
        with tarfile.open(fileobj=handle, mode="r:") as archive:
            while (member := archive.next()) is not None:
                archive.members = []  # an archive may hold more names than fit in memory
                name = member.name.rsplit("/", 1)[-1]
                if member.isfile() and name.endswith(self.suffix) and name[0] not in "._":
                    yield from _range(name, archive.extractfile(member), 0, member.size)


def _range(name: str, handle, start: int, end: int) -> Iterator[tuple]:
    """(file name, position, header, line) of the lines that begin in [start, end)."""
    top, header = _header(handle)
    none = True
    for at, line in _lines(handle, start, end):
        if at == top and header is not None:
            continue
        text = _text(line, at == 0)
        if text.strip():
            none = False
            yield name, at, header, text
    if start == 0 and header is None and none:
        yield name, 0, None, None  # an empty file: reported, without a line


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class ExportReader(_Reads, DataSourceReader):
    def partitions(self):
        # Spark wants one partition at least; an empty folder has none of its own
        return _ranges(_files(self.base, self.suffix), self.width) or [FileRanges([])]


class ExportStream(_Reads, DataSourceStreamReader):
    """New files of a folder as micro-batches.

    An offset counts entries of a log of (path, size) lists kept under ``logPath``, so a restart plans the same batches
    whatever the files' times and names; a file is taken once, by its path, and must be complete when its name appears."""

    def __init__(self, options):
        super().__init__(options)
        self.log = options["logpath"].rstrip("/")
        self.seen: set[str] | None = None
        self.last = 0

    def _entry(self, number: int) -> list[tuple[str, int]]:
        store, base = filesystem(self.log)
        with store.open_input_file(f"{base}/{number}.json") as handle:
            return [(p, n) for p, n in json.loads(handle.read())]

    def _load(self) -> None:
        store, base = filesystem(self.log)
        store.create_dir(base, recursive=True)
        numbers = sorted(int(f.base_name[:-5]) for f in store.get_file_info(fs.FileSelector(base)) if re.fullmatch(r"\d+\.json", f.base_name))
        self.last = numbers[-1] if numbers else 0
        self.seen = {p for n in numbers for p, _ in self._entry(n)}

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        if self.seen is None:
            self._load()
        new = [(p, n) for p, n in _files(self.base, self.suffix) if p not in self.seen]
        if new:
            store, base = filesystem(self.log)
            with store.open_output_stream(f"{base}/_{self.last + 1}.part") as handle:
                handle.write(json.dumps(new).encode())
            store.move(f"{base}/_{self.last + 1}.part", f"{base}/{self.last + 1}.json")
            self.last += 1
            self.seen.update(p for p, _ in new)
        return {"entry": self.last}

    def partitions(self, start: dict, end: dict):
        return _ranges([f for n in range(start["entry"] + 1, end["entry"] + 1) for f in self._entry(n)], self.width)

    def commit(self, end: dict) -> None:
        """The log stays: it tells which files were taken."""


class ExportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ExportReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ExportStream(self.options)


def scan(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """(file_name, position, header_line, line) of every line under ``path`` that is not blank; ``position`` is the line's
    byte offset. The header is a file's first such line; ``header_line`` is null in files that do not begin with one, and
    an empty file is one row with a null line."""
    spark.dataSource.register(ExportSource)
    return spark.read.format(FORMAT).option("rangeBytes", range_bytes).load(path)


def stream(spark: SparkSession, path: str, log_path: str, range_bytes: int = RANGE) -> DataFrame:
    """:func:`scan` of the files that arrive in ``path``; ``log_path`` (shared, one per query) keeps which were taken."""
    spark.dataSource.register(ExportSource)
    return spark.readStream.format(FORMAT).option("rangeBytes", range_bytes).option("logPath", log_path).load(path)


def rows(scanned: DataFrame) -> DataFrame:
    """Data lines split by their own file's header, as ``csv_export.split_rows`` gives them, with ``position``; no join."""
    cells = F.split("header_line", ",")
    place = F.array_position(F.transform(cells, lambda c: F.trim(c).startswith("Date (UTC")), True)
    data = (scanned.where(F.col("header_line").isNotNull() & ~is_header(F.col("line")))
            .select("file_name", "position", "line", cells.alias("header"), F.size(cells).alias("n_cols"), place.alias("date_idx"),
                    header_offset_minutes(F.element_at(cells, place.cast("int"))).alias("offset_min")))
    raw = F.split("line", ",", F.col("n_cols"))
    pad = F.array_repeat(F.lit(""), F.greatest(F.col("n_cols") - F.size(raw), F.lit(0)))
    return data.select("file_name", "position", "header", "date_idx", "offset_min", F.concat(raw, pad).alias("cells"), F.size(raw).alias("n_found"))


def rejected(scanned: DataFrame) -> DataFrame:
    """(file_name, reason) of the files that do not begin with a header."""
    return scanned.where(F.col("header_line").isNull()).select("file_name", F.lit("no date header").alias("reason")).distinct()


def backfill(scanned: DataFrame, mac_map: DataFrame) -> DataFrame:
    """Records with the ``device_id`` of the MAC in their file's name (JN5), null for an unknown one, in one pass; files
    without a MAC in their name are not loaded. ``position`` orders the lines of a file."""
    records = to_records(rows(scanned), keep=("position",)).withColumn("mac", F.upper(F.regexp_extract("file_name", FILE_RE, 1)))
    return records.where("mac <> ''").join(maybe_broadcast(mac_map.select("mac", "device_id")), "mac", "left")

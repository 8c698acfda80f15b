"""Web archives (WARC/1.1) in Zstandard: a dictionary in a leading skippable frame, then one frame per record."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from senslake.session import checkpoint_dir

from .common import join_small, land

#: Bytes of an archive file after which the next record starts another one (a longer record is one file's last).
ARCHIVE_BYTES = 64 << 20
#: Pages whose payloads train the dictionary, bytes of each that are used, and bytes of the dictionary.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16_384, 65_536
LEVEL = 3
#: Fixed values of the formats: skippable frame of a dictionary, Zstandard's frame and dictionary magics, record types, revisit profile.
SKIPPABLE, FRAME_MAGIC, DICTIONARY_MAGIC = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{row}')}>"


def _line(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {_line(v)}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def http_block(payload: bytes, full: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {full}\r\n\r\n".encode() + payload


class ArchiveError(ValueError):
    """An archive, frame or record that breaks its format."""


def frame_end(buf: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its block headers alone."""
    try:
        p = zstandard.get_frame_parameters(bytes(buf[at:at + 18]))
        at += zstandard.frame_header_size(bytes(buf[at:at + 18]))
        last = False
        while not last:
            head = int.from_bytes(buf[at:at + 3], "little")
            if at + 3 > len(buf) or head >> 1 & 3 == 3:
                raise ArchiveError("frame: broken block")
            last = bool(head & 1)
            at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
    except zstandard.ZstdError as e:
        raise ArchiveError(f"frame: {e}") from e
    at += 4 * p.has_checksum
    if at > len(buf):
        raise ArchiveError("frame: cut short")
    return at


@dataclass
class Record:
    fields: dict
    block: memoryview

    @property
    def payload(self) -> bytes:
        """Bytes after the HTTP header of an HTTP block, else the block."""
        block = bytes(self.block)
        if self.fields.get("content-type", "").startswith("application/http"):
            _, sep, body = block.partition(b"\r\n\r\n")
            if not sep:
                raise ArchiveError("record: no end of the HTTP header")
            return body
        return block


def parse_record(data: bytes) -> Record:
    """One record, whole: version, header lines, required fields, block length, end mark, digests."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] not in (b"WARC/1.1", b"WARC/1.0"):
        raise ArchiveError("record: no WARC header")
    fields: dict = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        key = name.decode("utf-8", "replace").lower()
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9a-z-]+", key):
            raise ArchiveError("record: broken header line")
        if key in fields and key != "warc-concurrent-to":
            raise ArchiveError(f"record: {key} twice")
        fields[key] = value.strip().decode("utf-8", "replace")
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ArchiveError(f"record: no {missing[0]}")
    if not re.fullmatch(r"[0-9]+", fields["content-length"]):
        raise ArchiveError("record: content-length is no number")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ArchiveError(f"record: content-length {n}, but {len(rest) - 4} bytes")
    if fields["warc-type"] not in TYPES:
        raise ArchiveError(f"record: type {fields['warc-type']}")
    if fields["warc-type"] == "revisit" and "warc-profile" not in fields:
        raise ArchiveError("record: revisit without a profile")
    record = Record(fields, memoryview(rest)[:n])
    for name, value in (("warc-block-digest", record.block), ("warc-payload-digest", None)):
        said = fields.get(name, "")
        if said.startswith("sha1:") and not (name == "warc-payload-digest" and fields["warc-type"] == "revisit"):
            if said[5:] != sha1_base32(record.payload if value is None else bytes(value)):
                raise ArchiveError(f"record: {name} differs")
    return record


def archive_records(content: bytes):
    """(offset, record or ArchiveError) of each record frame of one archive. The dictionary is loaded from the leading skippable frame (stored as it is or as a
    Zstandard frame of its own); an archive without one is read without. A broken record is reported and the next frame read; after a broken frame
    the rest cannot be found, so the archive ends there with the error."""
    buf, at, dictionary = memoryview(content), 0, None
    try:
        if len(buf) >= 8 and struct.unpack_from("<I", buf)[0] == SKIPPABLE:
            size = struct.unpack_from("<I", buf, 4)[0]
            at = 8 + size
            if at > len(buf):
                raise ArchiveError("dictionary: cut short")
            raw = bytes(buf[8:at])
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
            if raw[:4] != struct.pack("<I", DICTIONARY_MAGIC):
                raise ArchiveError("dictionary: no dictionary in the skippable frame")
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT)
        reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
        while at < len(buf):
            if len(buf) - at >= 8 and 0x184D2A50 <= struct.unpack_from("<I", buf, at)[0] <= 0x184D2A5F:
                at += 8 + struct.unpack_from("<I", buf, at + 4)[0]
                if at > len(buf):
                    raise ArchiveError("frame: cut short")
                continue
            end = frame_end(buf, at)
            try:
                frame = bytes(buf[at:end])
                size = zstandard.frame_content_size(frame)
                data = reader.decompress(frame) if size > 0 else reader.decompressobj().decompress(frame) if size < 0 else b""
                if 0 <= size != len(data):
                    raise ArchiveError(f"frame: {len(data)} bytes, its header says {size}")
                yield at, parse_record(data)
            except ArchiveError as e:
                yield at, e
            except zstandard.ZstdError as e:
                yield at, ArchiveError(f"frame: {e}")
            at = end
    except (ArchiveError, zstandard.ZstdError) as e:
        yield at, e if isinstance(e, ArchiveError) else ArchiveError(f"dictionary: {e}")


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A Zstandard dictionary, or nothing where the sample is too small for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, payloads).as_bytes()
    except zstandard.ZstdError:
        return b""


def _rows(batches):
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        page, url, html = batch.columns
        payload = html.fill_null("").cast(pa.binary())
        raw = payload.to_pylist()
        rows = pa.array((np.int64(part) << 33) + np.arange(n, n + len(raw)), pa.int64())
        n += len(raw)
        yield pa.RecordBatch.from_arrays([rows, page, url, payload, pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()), pa.array([sha1_base32(x) for x in raw]),
                                          pa.array([len(x) for x in raw], pa.int64())], names=["row", "page_id", "url", "payload", "content", "digest", "n"])


def _write(folder: str, dictionary, date: str, limit: int):
    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        info = TaskContext.get()
        own, k = f"part-{info.partitionId():06d}-{info.taskAttemptId():x}", 0
        raw = dictionary.value
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None, write_checksum=True, write_content_size=True)
        out, size, count, name = None, 0, 0, None

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"file": pa.array([name]), "records": pa.array([count], pa.int64()), "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for row, page, url, payload, digest, first_row, first_page, first_url in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if out is None:
                    name, size, count = f"{own}-{k:05d}.warc.zst", 0, 0
                    k += 1
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    head = struct.pack("<II", SKIPPABLE, len(raw)) + raw if raw else b""
                    out.write(head)
                    size += len(head)
                kind = "response" if first_row is None or first_row == row else "revisit"
                block = http_block(payload if kind == "response" else b"", len(payload))
                fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(row)), ("WARC-Date", date), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
                          ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")]
                fields += [("X-Page-ID", str(page))] if page is not None else []
                fields += [("WARC-Target-URI", url)] if url is not None else []
                if kind == "revisit":
                    fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(first_row))] + ([("WARC-Refers-To-Target-URI", first_url)] if first_url is not None else [])
                frame = pack.compress(build_record(fields, block))
                out.write(frame)
                size += len(frame)
                count += 1
                if size >= limit:
                    yield done()
                    out = None
        if out is not None:
            yield done()
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page as ``*.warc.zst`` files into ``folder`` (a URI that tasks can write to); the manifest (file, records, bytes) lists the files that count.

    Of records with equal payloads (SHA-256) of ``least_revisit`` bytes and more, that of the smallest id is a response with the payload, the others revisit it; shorter ones are all responses. Null payloads are
    empty, null ids come last, ties go by URL, then row; every repeat of a row is a record of its own. Extra columns are ignored; an empty table writes no files.

    The dictionary is trained on the first 16 KiB of 400 pages (by hash) at most and leads every file. Payloads and digests are landed once; only digests are grouped (with partial aggregates, so a payload of
    a third of all pages costs each task one row), and only those that repeat are joined back. A task that is run again writes files of another name; those of lost attempts are in no manifest."""
    spark = pages.sparkSession
    some = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("html"))
    sample = some.where("html <> ''").select(F.substring("html", 1, SAMPLE_BYTES).alias("x"), F.xxhash64("page_id", "url").alias("h")).orderBy("h", "x").limit(SAMPLE_PAGES)
    dictionary = spark.sparkContext.broadcast(train_dictionary([r.x.encode()[:SAMPLE_BYTES] for r in sample.collect()]))
    rows = land(some.mapInArrow(_rows, "row long, page_id long, url string, payload binary, content binary, digest string, n long"), "payloads")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "row")
    groups = rows.where(F.col("n") >= least_revisit).groupBy("content").agg(F.count("*").alias("c"), F.min(order).alias("f")).where("c > 1")
    firsts = groups.select("content", F.col("f.row").alias("first_row"), F.col("f.page_id").alias("first_page"), F.col("f.url").alias("first_url"))
    both = join_small(rows, firsts, ["content"], "repeats", limit=200_000)
    when = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    cols = both.select("row", "page_id", "url", "payload", "digest", *(F.when(F.col("n") >= least_revisit, F.col(c)).alias(c) for c in ("first_row", "first_page", "first_url")))
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    return land(cols.mapInArrow(_write(folder, dictionary, when, archive_bytes), "file string, records long, bytes long"), "manifest")


RECORD = "file string, offset long, type string, record_id string, target_uri string, page_id long, date string, digest string, refers_to string, payload binary, error string"


def _read(with_payload: bool):
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                held, size = [], 0
                for at, r in archive_records(content.as_py()):
                    if isinstance(r, ArchiveError):
                        held.append((path.as_py(), at, *[None] * 8, str(r)))
                    else:
                        f = r.fields
                        payload = r.payload
                        digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or sha1_base32(payload)
                        page = f.get("x-page-id")
                        held.append((path.as_py(), at, f["warc-type"], f["warc-record-id"], f.get("warc-target-uri"), int(page) if page else None, f["warc-date"], digest, f.get("warc-refers-to"),
                                     payload if with_payload else len(payload).to_bytes(8, "big"), None))
                        size += len(payload) if with_payload else 8
                    if size >= 8 << 20 or len(held) >= 10_000:
                        yield _batch(held, names)
                        held, size = [], 0
                if held:
                    yield _batch(held, names)
    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"offset": pa.int64(), "page_id": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def read_archives(spark: SparkSession, *paths: str, payloads: bool = True) -> DataFrame:
    """(file, offset, type, record_id, target_uri, page_id, date, digest, refers_to, payload, error): a row per record of the archives; broken ones have only ``error``.

    Spark lists and reads the files, a task takes one archive at a time. Each frame is decoded alone with the archive's own dictionary; frame length, header
    lines, required fields, Content-Length, end mark and digests are checked. With ``payloads=False`` the payload column holds the 8-byte big-endian length instead."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    return files.mapInArrow(_read(payloads), RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records read with ``payloads=False``; a revisit takes its size from the response that it names.
    Raises if a record is broken or a revisit's response is absent or has another digest."""
    n = F.conv(F.hex("payload"), 16, 10).cast("long")
    r = land(records.select("type", "record_id", "page_id", "digest", "refers_to", n.alias("n"), "error"), "records")
    if bad := r.where("error is not null").select("error").first():
        raise ArchiveError(bad.error)
    named = r.where("type = 'revisit'").select(F.col("refers_to").alias("record_id")).distinct()
    target = r.where("type = 'response'").join(named, "record_id").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("digest").alias("to_digest"), F.col("n").alias("to_n"))
    visits = join_small(r.where("type = 'revisit'"), target, ["refers_to"], "targets", limit=200_000)
    same = F.col("digest") == F.col("to_digest")
    sure = F.when(F.coalesce(same, F.lit(False)), F.col("to_n")).otherwise(F.raise_error(F.lit("a revisit without its response")).cast("long"))
    cols = [F.col("digest").alias("payload_digest"), F.col("type").alias("record_type")]
    plain = r.where("type = 'response'").select("page_id", F.col("n").alias("payload_bytes"), *cols, F.lit(None).cast("long").alias("refers_to"))
    return plain.unionByName(visits.select("page_id", sure.alias("payload_bytes"), *cols, F.col("to_page").alias("refers_to")))


def op13_zstd_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    files = [r.file for r in write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder).select("file").collect()]
    if not files:
        return resolved(spark.createDataFrame([], RECORD))
    return resolved(read_archives(spark, *(f"{folder}/{f}" for f in sorted(files)), payloads=False))


OP13_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
d AS (SELECT p.page_id, p.html, f.first, sha1(p.html) AS h FROM p JOIN f ON f.html = p.html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
         (((16 * (strpos('0123456789abcdef', substr(h, (5 * i // 4)::INT + 1, 1)) - 1) + greatest(strpos('0123456789abcdef', substr(h, (5 * i // 4)::INT + 2, 1)) - 1, 0)) >> (3 - 5 * i % 4)::INT) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

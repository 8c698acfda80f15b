"""Archives: round trips, the format as another reader sees it, and what a broken file gives."""

import base64
import collections
import hashlib
import struct

import pytest
import zstandard

from senslake.llm import warc


def brute(rows, least=0):
    first = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= least:
            first[p] = min(first.get(p, (True, 0)), (i is None, i or 0))
    out, done = [], set()
    for i, _, html in rows:
        p = (html or "").encode()
        f = first.get(p)
        new = len(p) < least or (f == (i is None, i or 0) and p not in done)
        done |= {p} if new else set()
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if new else "revisit", None if new or f[0] else f[1]))
    return collections.Counter(out)


@pytest.fixture(scope="module")
def pages():
    rows = [(i, f"https://a.example/{i}", f"<html><body>page {i % 40} " + "some words of a page " * (i % 17) + "</body></html>") for i in range(300)]
    return rows + [(900, None, None), (901, "https://b.example/\r\nWARC-Type: evil", ""), (None, "https://c.example", "no id"), (None, None, "no id"), (902, "u", "<p>é" + "x" * 300_000), (903, "u", "one"), (903, "u", "one"),
                   (903, "t", "one"), (904, "u", "WARC/1.1\r\n\r\n\r\n\r\n")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "x") for r in rows], "page_id long, url string, html string, row int, digest string, payload string")


def written(spark, rows, tmp_dir, **more):
    folder = f"file://{tmp_dir}/archives"
    files = warc.write_archives(frame(spark, rows).repartition(3), folder, **more).collect()
    return [f"{folder}/{f.file}" for f in files], files


@pytest.mark.parametrize("least", [0, 40])
def test_round_trip(spark, pages, tmp_dir, least):
    paths, files = written(spark, pages, tmp_dir, least_revisit=least, archive_bytes=6000)
    assert sum(f.records for f in files) == len(pages) and len(files) > 3
    got = warc.resolved(warc.read_archives(spark, *paths, payloads=False)).collect()
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(pages, least)
    whole = warc.read_archives(spark, *paths).collect()
    assert all(r.error is None for r in whole) and len({r.record_id for r in whole}) == len(pages)
    texts = collections.Counter((r.page_id, bytes(r.payload)) for r in whole if r.type == "response")
    assert all((i, p) in {(a, (h or "").encode()) for a, _, h in pages} for i, p in texts) and {p for _, p in texts} == {(h or "").encode() for _, _, h in pages}
    assert {r.target_uri for r in whole if r.page_id == 901} == {"https://b.example/%0D%0AWARC-Type: evil"}


def test_another_reader_finds_the_dictionary_and_a_frame_a_record(spark, pages, tmp_dir):
    paths, files = written(spark, pages, tmp_dir)
    raw = open(paths[0].removeprefix("file://"), "rb").read()
    magic, n = struct.unpack_from("<II", raw)
    assert magic == 0x184D2A5D
    reader, rest, records = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + n])), raw[8 + n:], []
    while rest:
        one = reader.decompressobj()
        records.append(one.decompress(rest))
        rest = one.unused_data
    assert len(records) == next(f.records for f in files if paths[0].endswith(f.file)) and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)


def test_no_pages_and_too_few_for_a_dictionary(spark, tmp_dir):
    assert written(spark, [], tmp_dir) == ([], [])
    paths, _ = written(spark, [(1, "u", "one page")], f"{tmp_dir}/one")
    raw = open(paths[0].removeprefix("file://"), "rb").read()
    assert struct.unpack_from("<I", raw)[0] == warc.FRAME_MAGIC
    assert [tuple(r)[:2] for r in warc.resolved(warc.read_archives(spark, *paths, payloads=False)).collect()] == [(1, 8)]


def record(**change):
    fields = {"WARC-Type": "resource", "WARC-Record-ID": "<urn:x>", "WARC-Date": "2024-01-01T00:00:00Z"} | change
    return warc.build_record([(k.replace("_", "-"), v) for k, v in fields.items() if v is not None], b"the block")


def errors(*frames, head=b""):
    return [str(r) if isinstance(r, warc.ArchiveError) else "ok" for _, r in warc.archive_records(head + b"".join(frames))]


def test_headers_and_lengths_are_validated():
    pack = zstandard.ZstdCompressor(write_checksum=True).compress
    good = pack(record())
    bad = {b"WARC/1.1": b"WARC/9.9", b"Content-Length: 9": b"Content-Length: 8", b"Content-Length: 9\r\n": b"", b"Content-Length: 9 ": b"x", b"resource": b"nonsense", b"WARC-Date: ": b"WARC Date; "}
    for a, b in bad.items():
        if a in record():
            assert errors(good, pack(record().replace(a, b, 1)), good)[1].startswith("record: ") and errors(good, pack(record().replace(a, b, 1)), good)[::2] == ["ok", "ok"]
    assert errors(pack(record(**{"WARC-Type": "revisit"}))) == ["record: revisit without a profile"]
    assert errors(pack(record(**{"WARC-Payload-Digest": "sha1:AAAA"}))) == ["record: warc-payload-digest differs"]
    assert errors(pack(record() + record()))[0].startswith("record: content-length")
    assert errors(pack(record().replace(b"WARC-Date", b"WARC-Type", 1))) == ["record: warc-type twice"]


def test_broken_frames_and_dictionaries_are_reported():
    pack = zstandard.ZstdCompressor(write_checksum=True).compress
    good = pack(record())
    assert errors(good, good[:-3]) == ["ok", "frame: cut short"]
    assert errors(good[:-1] + bytes([good[-1] ^ 1]), good)[1] == "ok" and errors(good[:-1] + bytes([good[-1] ^ 1]))[0].startswith("frame: ")
    assert errors(good, b"no frame at all")[1].startswith("frame: ")
    assert errors(good, head=struct.pack("<II", 0x184D2A5D, 4) + b"none") == ["dictionary: no dictionary in the skippable frame"]
    assert errors(head=struct.pack("<II", 0x184D2A5D, 400)) == ["dictionary: cut short"]
    texts = [f"WARC/1.1 page {i} of many words {i * 7}".encode() * 5 for i in range(400)]
    d = warc.train_dictionary(texts)
    with_d = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d)).compress(record())
    for stored in (d, zstandard.ZstdCompressor().compress(d)):
        assert errors(with_d, with_d, head=struct.pack("<II", 0x184D2A5D, len(stored)) + stored) == ["ok", "ok"]
    assert errors(with_d)[0].startswith("frame: ")
    assert errors(struct.pack("<II", 0x184D2A50, 3) + b"abc", good) == ["ok"]
    unsized = zstandard.ZstdCompressor(write_content_size=False).compress(record())
    assert errors(unsized) == ["ok"]


def test_a_broken_record_stops_the_query(spark, pages, tmp_dir):
    paths, _ = written(spark, pages[:50], tmp_dir)
    path = paths[0].removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[-1] ^= 1
    open(path, "wb").write(raw)
    bad = warc.read_archives(spark, *paths).where("error is not null").collect()
    assert len(bad) == 1 and bad[0].page_id is None and bad[0].offset > 0
    with pytest.raises(warc.ArchiveError):
        warc.resolved(warc.read_archives(spark, *paths, payloads=False))

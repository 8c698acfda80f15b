"""Token files: a shared frequency table and independent blocks of interleaved range asymmetric numeral systems."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from senslake.session import checkpoint_dir

from .common import blocks, documents, id_array, id_text, land, long_ids
from .tokenise import default_path, encoder

#: Table resolution, lanes per block, steps per block, tokens per frame.
SCALE, LANES, STEPS, FRAME = 20, 64, 512, 1 << 20
_LOW = np.uint64(1 << 31)
MAGIC = b"RANS0001"
#: Documents per file range (expected), and ranges at most.
RANGE_DOCS, RANGES = 4096, 20_000


class Table:
    """Frequencies quantised to a total of 2**SCALE; every counted symbol keeps one slot at least."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray):
        order = np.argsort(symbols)
        self.symbols, counts = symbols[order].astype(np.uint32), counts[order].astype(np.float64)
        total = 1 << SCALE
        if len(counts) > total:
            raise ValueError("more symbols than slots")
        f = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * total)).astype(np.int64)
        left = total - int(f.sum())
        while len(f) and left:
            by = np.argsort(-f, kind="stable")
            if left > 0:
                f[by[0]] += left
                break
            take = np.minimum(f[by] // 2, -left)
            take = np.minimum(take, np.maximum(0, -left - np.concatenate([[0], np.cumsum(take)[:-1]])))
            f[by] -= take
            left += int(take.sum())
        self.freq = f.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(f)[:-1]]).astype(np.uint64) if len(f) else np.zeros(0, np.uint64)
        self.slot = np.repeat(np.arange(len(f), dtype=np.int32), f)


def _encode(table: Table, syms: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """``syms`` (blocks, steps, lanes) of table indices -> final states (blocks, lanes) and words of each block."""
    b, steps, lanes = syms.shape
    x = np.full((b, lanes), _LOW, np.uint64)
    words = np.zeros((steps, b, lanes), np.uint32)
    sent = np.zeros((steps, b, lanes), bool)
    for j in range(steps - 1, -1, -1):
        s = syms[:, j]
        f = table.freq[s]
        out = x >= f << np.uint64(63 - SCALE)
        sent[j] = out
        words[j] = x.astype(np.uint32)
        x = np.where(out, x >> np.uint64(32), x)
        q = x // f
        x = (q << np.uint64(SCALE)) + (x - q * f) + table.start[s]
    return x, [words[:, i][sent[:, i]] for i in range(b)]


def _decode(table: Table, states: np.ndarray, words: np.ndarray, first: np.ndarray, steps: int) -> np.ndarray:
    b, lanes = states.shape
    x = states.copy()
    at = first.astype(np.int64).copy()
    words = np.concatenate([words, np.zeros(1, np.uint32)])
    out = np.zeros((b, steps, lanes), np.int32)
    low = np.uint64((1 << SCALE) - 1)
    for j in range(steps):
        slot = x & low
        s = table.slot[slot.astype(np.int64)]
        out[:, j] = s
        x = table.freq[s] * (x >> np.uint64(SCALE)) + slot - table.start[s]
        need = x < _LOW
        pos = at[:, None] + np.cumsum(need, axis=1) - 1
        x = np.where(need, (x << np.uint64(32)) | words[np.where(need, pos, len(words) - 1)], x)
        at += need.sum(axis=1)
    return out


def pack_frame(table: Table, ids: np.ndarray) -> bytes:
    """One frame: magic, number of ids, number of blocks, then a checkpoint per block (ids, words, CRC-32 of its ids), the blocks' lane states,
    and their words. Each block decodes alone from its checkpoint."""
    index = np.searchsorted(table.symbols, ids).astype(np.int32)
    full = len(ids) // (LANES * STEPS)
    heads, states, streams = [], [], []

    def add(part: np.ndarray, steps: int, lengths: list[int], raw: np.ndarray):
        x, words = _encode(table, part.reshape(-1, steps, LANES))
        at = 0
        for i, n in enumerate(lengths):
            heads.append((n, len(words[i]), zlib.crc32(raw[at:at + n].astype("<u4").tobytes())))
            at += n
        states.append(x.astype("<u8"))
        streams.extend(w.astype("<u4") for w in words)

    cut = full * LANES * STEPS
    if full:
        add(index[:cut], STEPS, [LANES * STEPS] * full, ids[:cut])
    if rest := len(ids) - cut:
        steps = -(-rest // LANES)
        add(np.concatenate([index[cut:], np.full(steps * LANES - rest, int(table.freq.argmax()), np.int32)]), steps, [rest], ids[cut:])
    head = np.array(heads, "<u4").reshape(-1, 3)
    return b"".join([MAGIC, np.array([len(ids), len(heads)], "<u4").tobytes(), head.tobytes(), *(s.tobytes() for s in states), *(w.tobytes() for w in streams)])


def unpack_frame(table: Table, frame: bytes) -> np.ndarray:
    """The ids of a frame; raises if a checksum fails."""
    if frame[:8] != MAGIC:
        raise ValueError("not a token frame")
    n, k = np.frombuffer(frame, "<u4", 2, 8).tolist()
    head = np.frombuffer(frame, "<u4", 3 * k, 16).reshape(k, 3).astype(np.int64)
    states = np.frombuffer(frame, "<u8", k * LANES, 16 + 12 * k).reshape(k, LANES).astype(np.uint64)
    words = np.frombuffer(frame, "<u4", -1, 16 + 12 * k + 8 * LANES * k)
    first = np.cumsum(head[:, 1]) - head[:, 1]
    full = int((head[:, 0] == LANES * STEPS).sum())
    parts = []
    if full:
        parts.append(_decode(table, states[:full], words, first[:full], STEPS).reshape(full, -1))
    if full < k:
        parts.append(_decode(table, states[full:], words, first[full:], -(-int(head[-1, 0]) // LANES)).reshape(1, -1)[:, :head[-1, 0]])
    blocks_ = [table.symbols[row] for part in parts for row in part]
    for i, ids in enumerate(blocks_):
        if zlib.crc32(ids.astype("<u4").tobytes()) != head[i, 2]:
            raise ValueError(f"checksum of block {i} differs")
    return np.concatenate(blocks_) if blocks_ else np.zeros(0, np.uint32)


def _ids(path: str, bounds: np.ndarray):
    def run(batches):
        enc = encoder(path)
        for block in blocks(batches, limit=2 << 20):
            ids, n = enc.block(block)
            raw, ends = ids.astype("<u2" if enc.tok.get_vocab_size() < 1 << 16 else "<u4"), np.cumsum(n)
            key = long_ids(block)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.searchsorted(bounds, key, "right"), pa.int32()), "ord": pa.array(key, pa.int64()), "doc_id": id_array(block), "n": pa.array(n, pa.int64()),
                "width": pa.array([raw.itemsize] * block.n, pa.int32()), "ids": pa.array([raw[e - k:e].tobytes() for e, k in zip(ends.tolist(), n.tolist(), strict=True)], pa.binary())})
    return run


def _histogram(batches):
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for raw, width in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            c = np.bincount(np.frombuffer(raw, f"<u{width}"))
            if len(c) > len(total):
                total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
            total[:len(c)] += c
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"token": pa.array(at, pa.int64()), "c": pa.array(total[at], pa.int64())})


def _frames(shared):
    def run(batches):
        table = Table(*shared.value)
        docs, lens, parts, part, size = [], [], [], None, 0
        key = [TaskContext.get().partitionId() << 32]

        def flush():
            ids = np.concatenate(parts)
            key[0] += 1
            return pa.RecordBatch.from_pydict({
                "key": pa.array(key, pa.int64()), "part": pa.array([part], pa.int32()), "first_doc": pa.array([order[0]], pa.int64()), "last_doc": pa.array([order[1]], pa.int64()), "n_tokens": pa.array([len(ids)], pa.int64()), "docs": pa.array([docs], pa.list_(pa.int64())),
                "lens": pa.array([lens], pa.list_(pa.int64())), "frame": pa.array([pack_frame(table, ids)], pa.binary())})

        order = [0, 0]
        for batch in batches:
            for p, o, d, n, w, raw in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if parts and (p != part or size >= FRAME):
                    yield flush()
                    docs, lens, parts, size = [], [], [], 0
                if not parts:
                    order[0] = o
                order[1], part = o, p
                docs.append(d)
                lens.append(n)
                parts.append(np.frombuffer(raw, f"<u{w}").astype(np.uint32))
                size += n
        if parts:
            yield flush()
    return run


_FRAME = "key long, part int, first_doc long, last_doc long, n_tokens long, docs array<long>, lens array<long>, frame binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write all documents' ids in ascending ``doc_id`` order under ``path``: ``table`` (token, count) and ``frames``.

    Each frame row names its document range and the documents' lengths, and holds blocks that decode alone. Null and
    empty texts are documents of the end id alone; null ids come last; rows that repeat an id keep their ids, ordered by length and content.
    Extra columns are ignored; an empty table writes no frames.

    One pass tokenises and deals documents into ranges of ids (landed, sorted), one counts the landed ids over all data,
    one encodes. The table is bounded by the vocabulary; a frame by 2**20 ids or one document."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    n = rows.count()
    ranges = min(RANGES, -(-n // RANGE_DOCS))
    at = rows.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 4 * RANGES).alias("b")).first()["b"] if ranges > 1 else []
    bounds = np.array(at or [], np.int64)
    ids = rows.mapInArrow(_ids(tokenizer or default_path(), bounds), "part int, ord long, doc_id long, n long, width int, ids binary")
    parts = max(1, min(ranges, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sorted_ = land(ids.repartition(parts, "part").sortWithinPartitions("part", "ord", "n", "ids"), "ids")
    counts = sorted_.select("ids", "width").mapInArrow(_histogram, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
    counts.coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(_read_table(spark, path))
    sorted_.select("part", "ord", "doc_id", "n", "width", "ids").mapInArrow(_frames(shared), _FRAME).write.option("compression", "uncompressed").parquet(f"{path}/frames")


def _read_table(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    got = spark.read.schema("token long, c long").parquet(f"{path}/table").orderBy("token").collect()
    return np.array([r[0] for r in got], np.int64), np.array([r[1] for r in got], np.int64)


def _unframe(shared):
    def run(batches):
        table = Table(*shared.value)
        for batch in batches:
            for base, docs, lens, frame in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids = unpack_frame(table, frame).astype("<u4")
                n = np.array(lens, np.int64)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(docs, pa.int64()), "start": pa.array(base + ends - n, pa.int64()), "n_tokens": pa.array(n),
                    "ids": pa.array([ids[e - k:e].tobytes() for e, k in zip(ends.tolist(), lens, strict=True)], pa.binary())})
    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``ids`` as little-endian unsigned 32-bit integers, ``start`` in the order of the files.

    Frames decode in parallel. ``start`` is the range's total before it (at most 20,000 ranges) plus a window inside the range."""
    frames = spark.read.schema(_FRAME).parquet(f"{path}/frames")
    shared = spark.sparkContext.broadcast(_read_table(spark, path))
    totals = frames.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    base = totals.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    w = Window.partitionBy("part").orderBy("first_doc", "last_doc", "key")
    place = frames.select("part", "key", (F.sum("n_tokens").over(w) - F.col("n_tokens")).alias("mine")).join(F.broadcast(base), "part")
    out = frames.join(place.select("key", (F.col("before") + F.col("mine")).alias("base")), "key")
    return out.select("base", "docs", "lens", "frame").mapInArrow(_unframe(shared), "doc_id long, start long, n_tokens long, ids binary")


def op8_interleaved_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
    write_tokens(documents(spark, sf_dir), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

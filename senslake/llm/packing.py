"""Best-fit packing by sums of squares: documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, documents, id_array, id_text, land
from .tokenise import default_path, encoder

CAPACITY = 4096
#: Pieces that one packing group places (expected; groups are dealt by hash).
GROUP = 50_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, turn long"


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches):
        enc = encoder(path)
        turn = TaskContext.get().partitionId() << 40
        for block in blocks(batches, limit=2 << 20):
            ids, n = enc.block(block)
            ends = np.cumsum(n)
            k = -(-n // capacity)
            doc = np.repeat(np.arange(block.n), k)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
            start = piece * capacity
            length = np.minimum(n[doc] - start, capacity)
            a = (ends - n)[doc] + start
            raw = ids.astype("<u4").tobytes()
            cut = [raw[4 * x:4 * (x + y)] for x, y in zip(a.tolist(), length.tolist(), strict=True)]
            cols = {"doc_id": id_array(block).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array([zlib.crc32(x) for x in cut], pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(cut, pa.binary())
            else:
                cols["turn"] = pa.array(turn + np.arange(len(doc)), pa.int64())
                turn += len(doc)
            yield pa.RecordBatch.from_pydict(cols)
    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, longest items first (ties in the given order).

    ``open_[g]`` counts the open bins with ``g`` free tokens. An item goes where the sum of ``open_[g] ** 2`` becomes
    smallest; of equal places it takes the one that leaves least room, and a new bin last."""
    open_ = np.zeros(capacity + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    bins = 0
    for i in order.tolist():
        s = int(lengths[i])
        gaps = np.flatnonzero(open_[s:capacity]) + s
        best = -1
        if len(gaps):
            cost = 2 * (open_[gaps - s] - open_[gaps]) + 2
            cost[gaps == s] -= 1  # a full bin is closed and counts no longer
            j = int(cost.argmin())
            if cost[j] <= 2 * open_[capacity - s] + 1:
                best = int(gaps[j])
        if best < 0:
            b, gap = bins, capacity
            bins += 1
        else:
            b, gap = stacks[best].pop(), best
            open_[best] -= 1
        where[i], offset[i] = b, capacity - gap
        if gap > s:
            open_[gap - s] += 1
            stacks.setdefault(gap - s, []).append(b)
    return where, offset


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        group = table.column("grp").to_numpy()
        where, offset = sum_of_squares(table.column("length").to_numpy(), capacity)
        return (table.drop_columns(["grp"]).append_column("sequence_id", pa.array(group.astype(np.int64) * (1 << 32) + where))
                .append_column("offset", pa.array(offset, pa.int64())))
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length 1..capacity, ids_crc32, turn) with ``sequence_id`` and gapless ``offset``.

    Pieces are dealt by a hash of ``turn``, a number that no two rows share, into groups of about ``group``: a row that
    comes a million times spreads like any other. Every group packs all its pieces by :func:`sum_of_squares`. A group's
    open bins at the end cost at most a few sequences in some ten thousand. Only lengths and keys travel, never tokens."""
    n = pieces.count()
    groups = max(1, -(-n // group))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = pieces.select(*cols, F.pmod(F.xxhash64("turn"), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInArrow(_pack(capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents as pieces of at most ``capacity`` tokens placed in sequences.

    Null and empty texts are documents of one token (the end id). Only documents longer than ``capacity`` are cut; the last piece may be
    shorter. Repeated rows are packed as often as they come; a null ``doc_id`` stays null. Extra columns are ignored; an empty table
    gives an empty result. Bins are reproducible for the same input files: rows are numbered as they are read, the
    numbers are landed, and a group's items are ordered by length, id, piece and checksum."""
    path = tokenizer or default_path()
    pieces = id_text(docs, id_col, text_col).mapInArrow(_pieces(path, capacity, False), PIECE)
    return pack(land(pieces, "pieces"), capacity)


def piece_ids(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): the pieces' little-endian unsigned 32-bit ids, to fill sequences."""
    return id_text(docs).mapInArrow(_pieces(tokenizer or default_path(), capacity, True),
                                    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def op1_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 tokens."""
    return pack_documents(documents(spark, sf_dir))

"""Shared helpers: landed intermediate tables and bounded blocks of documents inside Arrow tasks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from senslake.session import checkpoint_dir

#: Text bytes that one numpy block holds at most (a single longer document is its own block).
BLOCK_BYTES = 1 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: cuts lineage, so a lost executor
    repeats no finished stage. Shuffle files of the finished job are released."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    try:
        spark.conf.set(_CLEANUP, "true")
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a table that a task may hold whole, if they are a few numbers each.
SMALL_ROWS = 500_000


def join_small(df: DataFrame, small: DataFrame, on: list[str], name: str, how: str = "left", limit: int = SMALL_ROWS) -> DataFrame:
    """Join ``df`` to a table of narrow rows that is nearly always tiny: landed and counted, broadcast up to ``limit`` rows, shuffled beyond."""
    small = land(small, name)
    return df.join(F.broadcast(small) if small.count() <= limit else small, on, how)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents table, pruned to ``columns`` when given."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id long, text string): other columns, whatever their names, never reach an operator."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


@dataclass
class Block:
    """A few documents as one byte buffer. ``ids`` holds each column but the text; text nulls are empty here."""

    data: np.ndarray
    offs: np.ndarray
    null: np.ndarray
    rows: pa.RecordBatch

    @property
    def n(self) -> int:
        return len(self.offs) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offs[i]:self.offs[i + 1]].tobytes()


def release() -> None:
    """Give freed memory back to the machine. Workers are kept for the next stage, and with them the pages of freed arrays: the
    allocators hold them, and what each stage adds counts against the executor until it ends."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def blocks(batches: Iterable[pa.RecordBatch], text_col: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut Arrow batches into blocks of at most ``limit`` text bytes (whole documents only). Each batch's memory is released after it."""
    for batch in batches:
        if batch.num_rows:
            yield from _cut(batch, text_col, limit)
        del batch
        release()


def _cut(batch: pa.RecordBatch, text_col: str, limit: int) -> Iterator[Block]:
    col = batch.column(batch.schema.get_field_index(text_col))
    null = np.asarray(col.is_null().to_numpy(zero_copy_only=False))
    col = col.fill_null("").cast(pa.large_binary())
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset:]
    raw = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        o = offs[lo:hi + 1]
        yield Block(raw[o[0]:o[-1]], o - o[0], null[lo:hi], batch.slice(lo, hi - lo))
        lo = hi


def column(block: Block, name: str) -> pa.Array:
    return block.rows.column(block.rows.schema.get_field_index(name))


def long_ids(block: Block, name: str = "doc_id", null_as: int = np.iinfo(np.int64).max) -> np.ndarray:
    return column(block, name).fill_null(null_as).to_numpy(zero_copy_only=False)


def id_array(block: Block, name: str = "doc_id") -> pa.Array:
    return column(block, name)


def row_hash(seed: int):
    """A hash of (doc_id, text): different rows of one id differ, repeats of a row are alike."""
    return F.xxhash64("doc_id", "text", F.lit(seed))


def sample_rows(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """The ``n`` distinct rows (doc_id, text) of least hash, or all if fewer: never more, whatever ids or rows repeat.

    The threshold comes from the hashes of about 8 n rows; of all rows only where repeats leave fewer than ``n`` distinct ones there."""
    h, total = row_hash(seed), rows.count()
    for share in sorted({min(1.0, 8 * n / max(total, 1)), 1.0}):
        least = rows.select(h.alias("h")).where(F.col("h") <= F.lit(min(int(share * (1 << 64)), (1 << 64) - 1) - (1 << 63))).distinct().orderBy("h").limit(n)
        found, top = least.agg(F.count("*"), F.max("h")).first()
        if found == n:
            break
    if top is None:
        return rows.limit(0)
    return rows.withColumn("_h", h).where(F.col("_h") <= F.lit(top)).dropDuplicates(["_h"]).drop("_h")

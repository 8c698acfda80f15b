"""Conversation prefix trie: a count-min screen keeps proven singletons out of the shuffle; only prefixes that may be shared are grouped."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_small, land

#: Depths per block: running digests and sums are made inside blocks, then carried over, so no window holds a long conversation.
BLOCK = 4096
#: Count-min rows, counters per row at most (and per prefix), counters per chunk of the sketch.
ROWS, WIDTH, PER_PREFIX, CHUNK = 3, 1 << 27, 8, 1 << 20
#: Characters of joined ids that one row carries.
IDS_CHARS = 1 << 16
#: Leading characters of role and text that order turns of one number; beyond them digests do.
TIE_CHARS = 64


def _number(batches):
    """Row number of each row inside its conversation's run in this (sorted) partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        c = batch.column(0).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        size = np.diff(np.append(first, len(c)))
        i = np.arange(len(c)) - np.repeat(first, size) + 1
        if last == c[0]:
            i[:size[0]] += seen
        last, seen = c[-1], int(i[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i, pa.int64()), pa.array(np.full(len(c), part), pa.int32())], names=["conv_id", "a", "b", "chars", "i", "part"])


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, a, b, chars) with ``depth`` from 1 and a 128-bit digest (a, b) of (role, text), and (conv_id, length).

    Turns run by number (null first), ties by role, then text (64 characters of each, then digests); repeated rows are turns each. Null role or text is
    empty. Rows without a conversation id belong to none and take no part. Extra columns are ignored, texts stay where they are.

    The order comes from range partitions over all of these keys, so a conversation of any length spreads over tasks; what
    precedes each partition of such a conversation (one row a partition at most) is added afterwards."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.substring(role, 1, TIE_CHARS).alias("r"), F.substring(text, 1, TIE_CHARS).alias("x"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(text, F.lit(1), role).alias("b"), F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"))
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "r", "x", "a", "b", "row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("conv_id", "a", "b", "chars")
    turns = land(in_order.mapInArrow(_number, "conv_id long, a long, b long, chars long, i long, part int"), "turns")
    runs = land(turns.groupBy("conv_id", "part").agg(F.max("i").alias("n")), "runs")
    w = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("conv_id", "part", F.sum("n").over(w).alias("before")).where("before > 0")
    depth = F.col("i") + F.coalesce(F.col("before"), F.lit(0))
    out = turns.join(F.broadcast(before), ["conv_id", "part"], "left").select("conv_id", depth.alias("depth"), "a", "b", "chars")
    return out, runs.groupBy("conv_id").agg(F.sum("n").alias("length"))


def forked(turns: DataFrame, convs: DataFrame, family: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Every conversation rebuilt: the first h turns of its family's head (``conv_id - conv_id % family``; all if fewer, none if that is absent),
    then its own after its first h; h = crc32(decimal id) % ``heads``. The remainder takes the sign of the id.

    A head gives at most ``heads - 1`` turns to each of its family, so the join grows with the conversations."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    mine = convs.select("conv_id", "length", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("head"))
    head = convs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("head"), F.col("length").alias("head_length"))
    kept = F.least("h", F.coalesce(F.col("head_length"), F.lit(0)))
    plan = land(mine.join(head, "head", "left").select("conv_id", "head", "h", kept.alias("kept"), (kept + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length")), "forks")
    own = turns.join(plan, "conv_id").where("depth > h").select("conv_id", (F.col("depth") - F.col("h") + F.col("kept")).alias("depth"), "a", "b", "chars")
    given = turns.where((F.col("conv_id") % family == 0) & (F.col("depth") < heads)).withColumnRenamed("conv_id", "head")
    return own.unionByName(plan.join(given, "head").where("depth <= kept").select("conv_id", "depth", "a", "b", "chars")), plan.select("conv_id", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Digest (p1, p2) of each prefix, its parent's (q1, q2): exclusive or of the digests of (depth, turn) up to the depth."""
    z = turns.select("conv_id", "depth", "chars", F.xxhash64("depth", "a", "b").alias("z1"), F.xxhash64("b", "depth", "a", F.lit(2)).alias("z2"), F.floor((F.col("depth") - 1) / BLOCK).alias("block"))
    w = Window.partitionBy("conv_id", "block").orderBy("depth")
    x = land(z.select("*", F.bit_xor("z1").over(w).alias("x1"), F.bit_xor("z2").over(w).alias("x2")), "prefixes")
    w = Window.partitionBy("conv_id").orderBy("block")
    carried = x.where(F.col("depth") % BLOCK == 0).select("conv_id", (F.col("block") + 1).alias("block"), F.bit_xor("x1").over(w).alias("c1"), F.bit_xor("x2").over(w).alias("c2"))
    both = join_small(x, carried, ["conv_id", "block"], "carried")
    p = [F.col(f"x{i}").bitwiseXOR(F.coalesce(F.col(f"c{i}"), F.lit(0))) for i in (1, 2)]
    q = [p[i].bitwiseXOR(F.col(f"z{i + 1}")) for i in (0, 1)]
    return both.select("conv_id", "depth", "chars", p[0].alias("p1"), p[1].alias("p2"), q[0].alias("q1"), q[1].alias("q2"))


def _cells(p1: np.ndarray, p2: np.ndarray, width: int) -> np.ndarray:
    """Counter of each prefix in each row of the sketch, as one index (rows, prefixes)."""
    a, b = p1.view(np.uint64), p2.view(np.uint64) | np.uint64(1)
    return np.stack([((a + np.uint64(r) * b) & np.uint64(width - 1)).astype(np.int64) + r * width for r in range(ROWS)])


def _count(width: int, chunk: int):
    def run(batches):
        held, n = [], 0

        def out():
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            counts = np.minimum(counts, 2).astype(np.uint8)
            cut = np.flatnonzero(np.diff(cells // chunk)) + 1
            rows = [(int(c[0] // chunk), (c % chunk).astype("<u4").tobytes(), k.tobytes()) for c, k in zip(np.split(cells, cut), np.split(counts, cut), strict=True)]
            return pa.RecordBatch.from_pydict({"chunk": pa.array([r[0] for r in rows], pa.int32()), "cells": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

        for batch in batches:
            held.append(_cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), width).ravel())
            n += held[-1].size
            if n >= 1 << 22:
                yield out()
                held, n = [], 0
        if n:
            yield out()
    return run


def _merge(chunk: int):
    def run(batches):
        at, total = None, None

        def out():
            return pa.RecordBatch.from_pydict({"chunk": pa.array([at], pa.int32()), "bits": pa.array([np.packbits(total > 1, bitorder="little").tobytes()], pa.binary())})

        for batch in batches:
            for c, cells, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if c != at:
                    if at is not None:
                        yield out()
                    at, total = c, np.zeros(chunk, np.uint8)
                cells = np.frombuffer(cells, "<u4")
                total[cells] = np.minimum(total[cells] + np.frombuffer(counts, np.uint8), 2)
        if at is not None:
            yield out()
    return run


def count_min(prefixes: DataFrame) -> tuple[np.ndarray, int]:
    """A count-min sketch of the digests (p1, p2) with counters of 0, 1 and more: (bits of the counters above 1, counters per row).

    Eight counters per prefix in each of three rows, up to 2**27 (48 MiB of bits in all): beyond that more prefixes pass the screen, with the same results."""
    n = prefixes.count()
    width = 1 << min(WIDTH.bit_length() - 1, max(16, (PER_PREFIX * n).bit_length()))
    chunk = min(CHUNK, width)
    found = prefixes.select("p1", "p2").mapInArrow(_count(width, chunk), "chunk int, cells binary, counts binary")
    parts = max(1, min(ROWS * width // chunk, int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    bits = found.repartition(parts, "chunk").sortWithinPartitions("chunk").mapInArrow(_merge(chunk), "chunk int, bits binary")
    out = np.zeros(ROWS * width // 8, np.uint8)
    for c, b in land(bits, "sketch").collect():
        out[c * chunk // 8:(c + 1) * chunk // 8] = np.frombuffer(b, np.uint8)
    return out, width


def _screen(shared, width: int):
    """kind: 0 a singleton below a singleton, 1 a singleton below a prefix that may be shared, 2 a prefix that may be shared."""
    def more(p1, p2):
        cells = _cells(p1, p2, width)
        return ((shared.value[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=0)

    def run(batches):
        for batch in batches:
            depth, p1, p2, q1, q2 = (batch.column(i).to_numpy() for i in (1, 3, 4, 5, 6))
            kind = np.where(more(p1, p2), 2, np.where((depth == 1) | more(q1, q2), 1, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind, pa.int32())], names=[*batch.schema.names, "kind"])
    return run


def _join_ids(batches):
    """Runs of sorted ids of one prefix, comma-joined, in rows of a bounded length."""
    held, at, first, size = [], None, None, 0

    def out():
        return pa.RecordBatch.from_pydict({"p1": pa.array([at[0]], pa.int64()), "p2": pa.array([at[1]], pa.int64()), "first": pa.array([first], pa.int64()), "ids": pa.array([",".join(held)], pa.string())})

    for batch in batches:
        for p1, p2, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if at != (p1, p2) or size >= IDS_CHARS:
                if held:
                    yield out()
                held, at, first, size = [], (p1, p2), c, 0
            held.append(str(c))
            size += len(held[-1]) + 1
    if held:
        yield out()


def _sha(batches):
    """SHA-256 over the rows of each prefix, streamed in order."""
    at, h = None, None

    def out():
        return pa.RecordBatch.from_pydict({"p1": pa.array([at[0]], pa.int64()), "p2": pa.array([at[1]], pa.int64()), "ends_sha256": pa.array([h.hexdigest()], pa.string())})

    for batch in batches:
        for p1, p2, _, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if at != (p1, p2):
                if h:
                    yield out()
                at, h = (p1, p2), hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
    if h:
        yield out()


def _ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each prefix. A hash reads its input in order, so one prefix's rows of joined ids meet in one task, which streams them."""
    ends = rows.where("depth = length").select("p1", "p2", "conv_id")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = ends.repartitionByRange(parts, "p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id").mapInArrow(_join_ids, "p1 long, p2 long, first long, ids string")
    return runs.repartition(parts, "p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(_sha, "p1 long, p2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, depth, a, b, chars; depths from 1 without gaps) of the conversations ``convs`` (conv_id, length; even of length 0).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a node is named by its depth and its smallest member; the root has depth 0.
    ``saved_tokens`` sums (n_convs - 1) * chars over the subtree, ``ends_sha256`` hashes the ids that end at the node. No conversations: no rows.

    A count-min sketch counts all prefix digests. An estimate of one proves a prefix, and all that extend it, a singleton: such tails become rows where they lie. Prefixes that may be shared, and the first
    singleton of each conversation, are grouped by digest (128 bits) with partial aggregates; a prefix of a third of all conversations costs each task one row. Sums over subtrees
    need no walk: each node's share is laid on its smallest member, summed up that member's path, and grouped by prefix."""
    rootless = convs.agg(F.min("conv_id")).first()[0]
    x = land(_prefixes(turns).join(convs, "conv_id"), "trie-prefixes")
    bits, width = count_min(x)
    shared = turns.sparkSession.sparkContext.broadcast(bits)
    screened = land(x.select("conv_id", "depth", "chars", "p1", "p2", "q1", "q2", "length").mapInArrow(
        _screen(shared, width), "conv_id long, depth long, chars long, p1 long, p2 long, q1 long, q2 long, length long, kind int"), "screened")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("chars"), zero.alias("p1"), zero.alias("p2"), zero.alias("q1"), zero.alias("q2"), "length", F.lit(2).alias("kind"))
    first = screened.where("kind = 1").groupBy("conv_id").agg(F.min("depth").alias("first"))
    known = land(screened.where("kind > 0").unionByName(roots).join(first, "conv_id", "left"), "known")
    rows = known.where("kind = 2 and (first is null or depth < first)")
    edge = known.where("kind = 1 and depth = first")
    false_hits = known.where("depth > first")

    nodes = rows.groupBy("p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.max("chars").alias("chars"))
    nodes = land(nodes, "trie-groups")
    below = edge.select("q1", "q2").unionByName(nodes.where("depth > 0").select("q1", "q2")).groupBy("q1", "q2").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(below.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), "n_children"), ["p1", "p2"], "left").fillna(0, ["n_children"])
    nodes = land(nodes, "trie-nodes")

    share = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"))
    v = rows.select("conv_id", "depth", "p1", "p2", F.when(F.col("first").isNotNull(), 1).otherwise(0).cast("long").alias("tail")).join(share, ["conv_id", "depth"], "left")
    v = v.fillna(0, ["saved", "leaf"]).withColumn("block", F.floor(F.col("depth") / BLOCK))
    w = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc())
    v = land(v.select("conv_id", "depth", "block", "p1", "p2", "tail", F.sum("saved").over(w).alias("saved"), F.sum("leaf").over(w).alias("leaf")), "shares")
    w = Window.partitionBy("conv_id").orderBy(F.col("block").desc())
    carried = v.where((F.col("depth") % BLOCK == 0) & (F.col("depth") > 0)).select("conv_id", (F.col("block") - 1).alias("block"), F.sum("saved").over(w).alias("more_saved"), F.sum("leaf").over(w).alias("more_leaf"))
    v = join_small(v, carried, ["conv_id", "block"], "shares-carried").fillna(0, ["more_saved", "more_leaf"])
    sums = v.groupBy("p1", "p2").agg(F.sum(F.col("saved") + F.col("more_saved")).alias("saved_tokens"), F.sum(F.col("leaf") + F.col("more_leaf") + F.col("tail")).alias("n_leaves"))

    none = F.sha2(F.lit("").cast("binary"), 256)
    big = nodes.join(sums, ["p1", "p2"]).join(_ends(rows), ["p1", "p2"], "left").select(
        "conv_id", "depth", "q1", "q2", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))

    def alone(df: DataFrame, *more: str) -> DataFrame:
        end = F.col("depth") == F.col("length")
        return df.select("conv_id", "depth", *more, F.lit(1).cast("long").alias("n_convs"), F.when(end, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                         zero.alias("saved_tokens"), F.when(end, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(none).alias("ends_sha256"))

    of = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    named = big.unionByName(alone(edge, "q1", "q2"))
    deep = named.where("depth > 1").join(of, ["q1", "q2"])
    top = named.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(rootless).cast("long")))
    tails = alone(screened.where("kind = 0").select("conv_id", "depth", "length").unionByName(false_hits.select("conv_id", "depth", "length"))).withColumn("parent_conv_id", F.col("conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return deep.select(*out).unionByName(top.select(*out)).unionByName(tails.select(*out))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on its family's head."""
    return prefix_trie(*forked(*numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, n,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(conv_id::VARCHAR)), lambda i: ord(substr(conv_id::VARCHAR, i::INT + 1, 1))::BIGINT)),
           lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)::BIGINT[]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
p AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS kept FROM c LEFT JOIN c b ON b.conv_id = c.head),
r AS (
  SELECT p.conv_id, t.pos AS depth, t.role, t.text FROM p JOIN t ON t.conv_id = p.head AND t.pos <= p.kept
  UNION ALL SELECT p.conv_id, t.pos - p.h + p.kept, t.role, t.text FROM p JOIN t ON t.conv_id = p.conv_id AND t.pos > p.h),
s AS (
  SELECT conv_id, depth::BIGINT AS depth, length(text) AS chars, max(depth) OVER (PARTITION BY conv_id) AS len,
         string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
         string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS up
  FROM r),
x AS (
  SELECT conv_id, depth, chars, path, coalesce(up, '') AS up, depth = len AS ends FROM s
  UNION ALL SELECT conv_id, 0, 0, '', NULL, n_turns = 0 FROM (SELECT p.conv_id, kept + greatest(n - h, 0) AS n_turns FROM p)),
g AS (
  SELECT path, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM x GROUP BY path, depth),
k AS (SELECT g.*, coalesce(d.n_children, 0) AS n_children
  FROM g LEFT JOIN (SELECT depth - 1 AS depth, up, count(*) AS n_children FROM g GROUP BY ALL) d ON d.depth = g.depth AND d.up = g.path),
sub AS (
  SELECT x.path, x.depth, sum((k.n_convs - 1) * k.chars)::BIGINT AS saved_tokens, (count(*) FILTER (WHERE k.n_children = 0))::BIGINT AS n_leaves
  FROM k JOIN x ON x.conv_id = k.conv_id AND x.depth <= k.depth GROUP BY x.path, x.depth)
SELECT k.conv_id, k.depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, sub.n_leaves, sub.saved_tokens, k.ends_sha256
FROM k JOIN sub ON sub.path = k.path AND sub.depth = k.depth LEFT JOIN k u ON u.path = k.up AND u.depth = k.depth - 1
"""

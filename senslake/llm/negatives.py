"""Hard-negative mining over an inverted multi-index: cells of two half-space codebooks, visited by summed bounds until the answer is certified."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_small, land

#: Codewords per half, rows that the codebooks are fitted on (at most), rounds of fitting.
WORDS, SAMPLE, ROUNDS = 16, 4096, 8
#: Index rows per shard, anchors per block (at most): one task holds one of each.
SHARD, ANCHORS = 16_384, 2048
#: Index rows scored at once while cells are visited.
SCORE_ROWS = 2048
#: Components have to stay below this, so that every inner product fits 64 bits.
LARGEST = 1 << 24


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(vec_id, label, q array<long>): ``q`` = floor(scale * x), x as double. Rows with a null id, label or vector, or a null or non-finite component are left out, and so are
    empty vectors. Repeated rows and ids are rows each; extra columns are ignored."""
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where("vec_id is not null and label is not null and v is not null and size(v) > 0").where(~bad)
    return v.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("q"))


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _fit(half: np.ndarray, words: int) -> np.ndarray:
    """Lloyd's rounds from evenly spaced rows; the codewords steer the order of visits, never the result."""
    if not half.shape[1]:
        return np.zeros((1, 0))
    half = np.unique(half, axis=0)
    centres = half[np.linspace(0, len(half) - 1, min(words, len(half))).astype(int)].astype(np.float64)
    for _ in range(ROUNDS):
        near = _nearest(half, centres)
        for k in range(len(centres)):
            if (near == k).any():
                centres[k] = half[near == k].mean(axis=0)
    return centres


def _nearest(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * (half @ centres.T)).argmin(axis=1)


def _assign(books):
    def run(batches):
        one, two = books.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column(2))
            if np.abs(q).max() >= LARGEST:
                raise ValueError(f"a component of {LARGEST} or more")
            h = one.shape[1]
            cell = _nearest(q[:, :h], one) * len(two) + _nearest(q[:, h:], two)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=["vec_id", "label", "q", "shard", "cell"])
    return run


_SHARD = "shard long, n int, ids binary, labels binary, cells binary, q binary"


def _pack(batches):
    """Rows sorted by (shard, cell) -> shards as columns of bytes, in pieces of ``SHARD`` rows at most."""
    held, at, n = [], None, 0

    def out():
        cols = [np.concatenate([h[i] for h in held]) for i in range(4)]
        cols[3] = cols[3].astype("<i2" if np.abs(cols[3]).max() < 1 << 15 else "<i4")
        return pa.RecordBatch.from_pydict({"shard": pa.array([at], pa.int64()), "n": pa.array([n], pa.int32()), **{k: pa.array([c.tobytes()], pa.binary()) for k, c in zip(("ids", "labels", "cells", "q"), cols, strict=True)}})

    for batch in batches:
        shard = batch.column(3).to_numpy()
        cut = np.flatnonzero(np.diff(shard)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(shard)], strict=True):
            if lo == hi:
                continue
            if at is not None and at != shard[lo]:
                yield out()
                held, n = [], 0
            at = int(shard[lo])
            part = batch.slice(lo, hi - lo)
            held.append((part.column(0).to_numpy().astype("<i8"), part.column(1).to_numpy().astype("<i8"), part.column(4).to_numpy().astype("<i4"), _matrix(part.column(2)).astype("<i4").ravel()))
            n += hi - lo
    if held:
        yield out()


class Shard:
    """One shard of the index: rows grouped by cell; per codeword the radius over all rows here that have it."""

    def __init__(self, row: dict, books):
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        cells = np.frombuffer(row["cells"], "<i4")
        self.books, self.half = books, books[0].shape[1]
        dim = self.half + books[1].shape[1]
        q = np.frombuffer(row["q"], f"<i{len(row['q']) // (len(cells) * dim)}").reshape(-1, dim).astype(np.int64)
        self.cells, first = np.unique(cells, return_index=True)
        self.first, self.last = first, np.append(first[1:], len(cells))
        self.of = {int(c): k for k, c in enumerate(self.cells)}
        halves = (q[:, :self.half], q[:, self.half:])
        words = (cells // len(books[1]), cells % len(books[1]))
        self.radius = []
        for k in (0, 1):
            r = np.zeros(len(books[k]))
            np.maximum.at(r, words[k], np.sqrt(((halves[k] - books[k][words[k]]) ** 2).sum(axis=1)))
            self.radius.append(r)
        # Sums of a row stay below its squared norm times the anchor's, so these types are exact.
        self.norm = float((q.astype(np.float64) ** 2).sum(axis=1).max())
        self.q = q.astype(np.float32 if self.norm < 1 << 24 else np.float64 if self.norm < 1 << 52 else np.int64)

    def scores(self, lo: int, hi: int, a: np.ndarray) -> np.ndarray:
        """Exact integer inner products of rows lo..hi."""
        norm = max(self.norm, float((a.astype(np.float64) ** 2).sum()))
        kind = self.q.dtype if norm <= self.norm else np.dtype(np.float64 if norm < 1 << 52 else np.int64)
        return (self.q[lo:hi].astype(kind, copy=False) @ a.astype(kind)).astype(np.int64)

    def bounds(self, a: np.ndarray) -> list[np.ndarray]:
        """Per half and codeword: no row with it has a half score above this."""
        out = []
        for k, part in enumerate((a[:self.half], a[self.half:])):
            part = part.astype(np.float64)
            top = self.books[k] @ part + np.sqrt((part ** 2).sum()) * self.radius[k]
            out.append(top + 1e-9 * np.abs(top) + 1e-6)
        return out

    def visits(self, a: np.ndarray):
        """(bound, first row, last row) of each cell that holds rows, by falling bound: a multi-sequence heap over both halves' sorted bounds."""
        one, two = self.bounds(a)
        by1, by2 = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        s1, s2 = one[by1].tolist(), two[by2].tolist()
        n2 = len(two)
        heap = [(-(s1[0] + s2[0]), 0, 0)]
        while heap:
            b, i, j = heapq.heappop(heap)
            if j + 1 < len(s2):
                heapq.heappush(heap, (-(s1[i] + s2[j + 1]), i, j + 1))
            if not j and i + 1 < len(s1):
                heapq.heappush(heap, (-(s1[i + 1] + s2[0]), i + 1, 0))
            k = self.of.get(int(by1[i]) * n2 + int(by2[j]))
            if k is not None:
                yield -b, int(self.first[k]), int(self.last[k])

    def search(self, a: np.ndarray, take, floor) -> None:
        """Give ``take(scores, rows)`` cells by falling bound until no unvisited row can score ``floor()`` or more."""
        held, n = [], 0

        def flush():
            take(np.concatenate([self.scores(lo, hi, a) for lo, hi in held]), np.concatenate([np.arange(lo, hi) for lo, hi in held]))

        for bound, lo, hi in self.visits(a):
            if bound < floor():
                break
            held.append((lo, hi))
            n += hi - lo
            if n >= SCORE_ROWS:
                flush()
                held, n = [], 0
        if held:
            flush()


class Best:
    """The first ``k`` of the rows offered, by falling score, then id."""

    def __init__(self, k: int, low: float = -np.inf, high: float = np.inf):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> float:
        """Scores below it are no use."""
        return self.low if len(self.scores) < self.k else max(self.low, int(self.scores[-1]))

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        at = np.flatnonzero((scores >= self.floor) & (scores <= self.high))
        if len(at):
            s, i = np.concatenate([self.scores, scores[at]]), np.concatenate([self.ids, ids[at]])
            by = np.lexsort((i, -s))[:self.k]
            self.scores, self.ids = s[by], i[by]


def _positives(books, k: int):
    def run(key, left, right):
        shard, found = Shard(right.to_pylist()[0], books.value) if right.num_rows else None, []
        for row in left.to_pylist() if shard else []:
            a, ids, labels = _anchors(row)
            for n, i, label, q in zip(row["rows"], ids.tolist(), labels.tolist(), a, strict=True):
                best = Best(k)
                shard.search(q, lambda s, at, best=best, i=i, label=label: best.offer(*_keep(s, shard.ids[at], (shard.labels[at] == label) & (shard.ids[at] != i))), lambda best=best: best.floor)
                found.extend((n, i, int(p), int(s)) for s, p in zip(best.scores, best.ids, strict=True))
        return pa.Table.from_pylist([dict(zip(("row", "anchor_id", "positive_id", "positive_score"), f, strict=True)) for f in found], _schema(["row", "anchor_id", "positive_id", "positive_score"]))
    return run


def _keep(scores: np.ndarray, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return scores[mask], ids[mask]


def _negatives(books, k: int, least: int, most: int):
    names = ["row", "anchor_id", "place", "positive_id", "negative_id", "positive_score", "negative_score"]

    def run(key, left, right):
        shard, found = Shard(right.to_pylist()[0], books.value) if right.num_rows else None, []
        for row in left.to_pylist() if shard else []:
            a, ids, labels = _anchors(row)
            for n, i, label, q, wanted in zip(row["rows"], ids.tolist(), labels.tolist(), a, row["positives"], strict=True):
                windows = [(p, Best(k, -(-least * p["positive_score"] // 100), most * p["positive_score"] // 100)) for p in wanted]
                windows = [(p, b) for p, b in windows if b.low <= b.high]
                if not windows:
                    continue

                def take(s, at, label=label, windows=windows):
                    s, other = _keep(s, shard.ids[at], shard.labels[at] != label)
                    for _, b in windows:
                        b.offer(s, other)

                shard.search(q, take, lambda windows=windows: min(b.floor for _, b in windows))
                found.extend((n, i, p["place"], p["positive_id"], int(x), p["positive_score"], int(s)) for p, b in windows for s, x in zip(b.scores, b.ids, strict=True))
        return pa.Table.from_pylist([dict(zip(names, f, strict=True)) for f in found], _schema(names))
    return run


def _schema(names: list[str]) -> pa.Schema:
    return pa.schema([(n, pa.int64()) for n in names])


def _anchors(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, q = np.array(row["ids"], np.int64), np.array(row["q"], np.int64)
    if np.abs(q).max() >= LARGEST:
        raise ValueError(f"a component of {LARGEST} or more")
    return q.reshape(len(ids), -1), ids, np.array(row["labels"], np.int64)


def _blocks(anchors: DataFrame, blocks: int, shards: int, *more: str) -> DataFrame:
    """Anchors in blocks of bounded size, one copy for each shard: the stated query set goes against the whole index in blocks."""
    one = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    part = F.struct("row", "vec_id", "label", "q", *more)
    grouped = one.groupBy("block").agg(F.collect_list(part).alias("p"))
    cols = [F.col("p.row").alias("rows"), F.col("p.vec_id").alias("ids"), F.col("p.label").alias("labels"), F.flatten("p.q").alias("q"), *(F.col(f"p.{m}").alias(m) for m in more)]
    return grouped.select("block", *cols, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, words: int = WORDS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ``anchors`` against all ``rows`` (both vec_id, label, q as :func:`quantised` gives them).

    A row's score is its inner product with the anchor. An anchor's positives are its first ``positives`` rows of its label and another id, by falling score, then id; for each, the
    first ``negatives`` rows of other labels are returned whose score lies between ``least`` and ``most`` per cent of the positive's. Fewer where there are fewer; none for a negative positive score.

    The index is all rows: two codebooks, one a half of the components, fitted on at most 4,096 rows (by hash), give each row a cell; rows are dealt by number into shards of about 16,384, sorted by cell.
    Every block of anchors meets every shard once in a pass for positives and once for negatives. In a shard a heap walks the pairs of codewords by falling sum of their bounds, which hold for every row of
    the cell (centre score plus anchor norm times radius), and stops when no unvisited cell can hold a row that counts. So results equal a full scan (recall 1) whatever the data; where bounds are loose, as on
    evenly spread vectors of many dimensions, most cells are visited. A third of all rows in one cell or with one label spread over all shards.

    Vectors shorter or longer than the most frequent length (the longer of equals) take no part. Components below 2**24 in size; larger ones raise. Repeated rows are rows each; an empty table gives none."""
    spark = rows.sparkSession
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    none = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    sizes = rows.groupBy(F.size("q").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return none
    dim, n = sizes
    rows, anchors = (df.where(F.size("q") == dim) for df in (rows, anchors))
    sample = rows.orderBy(F.xxhash64("vec_id", "q"), "vec_id").limit(SAMPLE).select("q").toArrow()
    points = _matrix(sample.column(0).combine_chunks()).astype(np.float64)
    books = spark.sparkContext.broadcast((_fit(points[:, :-(-dim // 2)], words), _fit(points[:, -(-dim // 2):], words)))
    shards = -(-n // SHARD)
    numbered = rows.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    assigned = numbered.mapInArrow(_assign(books), "vec_id long, label long, q array<long>, shard long, cell int")
    packed = assigned.repartition(min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard").sortWithinPartitions("shard", "cell").mapInArrow(_pack, _SHARD)
    index = land(packed, "multi-index")
    anchors = land(anchors.withColumn("row", F.monotonically_increasing_id()), "anchors")
    m = anchors.count()
    if not m:
        return none
    blocks = min(m, max(-(-m // ANCHORS), -(-2 * spark.sparkContext.defaultParallelism // shards)))
    sides = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def meet(left: DataFrame, f, schema: str) -> DataFrame:
        return left.groupBy("shard", "block").cogroup(sides.groupBy("shard", "block")).applyInArrow(f, schema)

    near = meet(_blocks(anchors, blocks, shards), _positives(books, positives), "row long, anchor_id long, positive_id long, positive_score long")
    w = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("place", F.row_number().over(w)).where(F.col("place") <= positives)
    wanted = best.groupBy("row").agg(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "positive_id", "positive_score")).alias("positives"))
    asked = join_small(anchors, wanted, ["row"], "positives", "inner", 100_000)
    far = meet(_blocks(asked, blocks, shards, "positives"), _negatives(books, negatives, least, most),
               "row long, anchor_id long, place long, positive_id long, negative_id long, positive_score long, negative_score long")
    w = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    return far.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives).select(*names)


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row of embeddings against all rows; every seventh row's label moves on by one."""
    rows = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn("label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end"))
    return hard_negatives(rows, rows.where("vec_id % 50 = 0"))


OP12_SQL = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS i FROM e),
bad AS (SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x)),
q AS (SELECT vec_id, label, i, floor(256 * x::DOUBLE)::BIGINT AS x FROM u WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS score
  FROM q a JOIN q b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

"""Quality rules: surface counts, and a hashed n-gram log-likelihood ratio of trusted to raw text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Block, blocks, documents, id_array, id_text, land
from .words import HEAD, doc_bounds, mix, per_doc, span_hash, spans, window_hash

#: Buckets of the hashed n-grams (word 1- and 2-grams, byte 3-grams), and additive smoothing in counts.
BUCKETS = 1 << 16
SMOOTH = 1.0
#: Trusted ids are broadcast up to this number (16 MB); more are joined.
BROADCAST_IDS = 2_000_000
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def surface(block: Block, start, end, doc, h) -> list[np.ndarray]:
    """The counts of ``_FIELDS`` for each document."""
    n = block.n
    heads = np.concatenate([[0], np.cumsum(HEAD[block.data])])
    out = [per_doc(n, doc), per_doc(n, doc, heads[end] - heads[start])]
    marks = np.concatenate([[0], np.cumsum(_SYMBOL[block.data])])
    out.append(marks[block.offs[1:]] - marks[block.offs[:-1]])
    ls, le, ld = spans(block, _NEWLINE)
    if len(ls):
        full = np.searchsorted(start, ls) < np.searchsorted(start, le)
        ls, le, ld = ls[full], le[full], ld[full]
    key = span_hash(block.data, ls, le) ^ mix(ld.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    out.append(per_doc(n, ld) - per_doc(n, ld[first]))
    w, at = window_hash(h, doc, 5)
    _, back, count = np.unique(w ^ mix(doc[at].astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
    cover = np.zeros(len(h) + 1, np.int64)
    twice = at[count[back] > 1]
    cover[twice] += 1
    cover[twice + 5] -= 1
    covered = np.cumsum(cover[:-1]) > 0
    out.append(per_doc(n, doc[covered]))
    return out


def grams(block: Block, doc, h) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every n-gram: words, pairs of words, and three bytes in a row."""
    two, at = window_hash(h, doc, 2)
    d = block.data.astype(np.uint64)
    n = max(len(d) - 2, 0)
    at3 = np.arange(n)
    doc3 = np.searchsorted(block.offs, at3, "right") - 1
    same = block.offs[doc3 + 1] >= at3 + 3
    three = (mix(d[:n] << np.uint64(16) | d[1:n + 1] << np.uint64(8) | d[2:n + 2]) if n else np.zeros(0, np.uint64))[same]
    top = np.uint64(64 - 16)
    return (np.concatenate([doc, doc[at], doc3[same]]),
            (np.concatenate([h, two ^ np.uint64(0xABCDEF), three ^ np.uint64(0x123457)]) >> top).astype(np.int64))


def _count(shared):
    """Counts of one task; trusted documents by a broadcast list of ids, or by the column ``trusted``."""
    def run(batches):
        raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for block in blocks(batches):
            start, end, doc = spans(block)
            d, g = grams(block, doc, span_hash(block.data, start, end))
            raw += np.bincount(g, minlength=BUCKETS)
            if shared is None:
                good = block.rows.column(block.rows.schema.get_field_index("trusted")).to_numpy(zero_copy_only=False).astype(bool)
            else:
                good = np.isin(id_array(block).fill_null(-1).to_numpy(zero_copy_only=False), shared.value) & ~np.asarray(id_array(block).is_null())
            if good.any():
                trusted += np.bincount(g[good[d]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "raw": pa.array(raw[at]), "trusted": pa.array(trusted[at])})
    return run


def _score(weights):
    def run(batches):
        w = np.frombuffer(weights.value, np.float64)
        for block in blocks(batches):
            start, end, doc = spans(block)
            h = span_hash(block.data, start, end)
            d, g = grams(block, doc, h)
            total, n = np.bincount(d, w[g], block.n), np.bincount(d, minlength=block.n)
            cols = dict(zip(_FIELDS, (pa.array(x, pa.int64()) for x in surface(block, start, end, doc, h)), strict=True))
            yield pa.RecordBatch.from_pydict({"doc_id": id_array(block), **cols, "llr": pa.array(total / np.maximum(n, 1))})
    return run


def quality_rules(docs: DataFrame, labels: DataFrame, broadcast_ids: int = BROADCAST_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept) for every document.

    ``labels`` (doc_id, quality 0/1): documents labelled 1 are the trusted target. ``llr`` is the mean, over a
    document's n-grams, of log(trusted share / raw share) of the n-gram's bucket; both multinomials count every document of theirs.
    The threshold is the one of 4,096 fixed steps that best separates the labelled documents (largest sum of the
    two classes' shares on the right side, the lowest such step); without both classes it is -infinity.
    ``kept``: not ``base_failed`` and ``llr >= threshold``; every document is judged, none is sampled.
    Null or empty text has no words and fails the base rule. Null ids stay and have no label; repeated rows each come back; labels that
    repeat an id count as trusted if any is 1. Trusted ids are broadcast up to ``broadcast_ids``,
    joined beyond, with the same result. Extra columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q")).where("doc_id is not null and q is not null").groupBy("doc_id").agg(F.max("q").alias("q"))
    good = marks.where("q = 1").select("doc_id")
    schema = "bucket int, raw long, trusted long"
    if good.count() <= broadcast_ids:
        ids = np.sort(np.array([r[0] for r in good.toLocalIterator()], np.int64))
        counted = rows.mapInArrow(_count(spark.sparkContext.broadcast(ids)), schema)
    else:
        known = rows.join(good.withColumn("trusted", F.lit(True)), "doc_id", "left")
        counted = known.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")).mapInArrow(_count(None), schema)
    counted = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
    table = np.zeros((2, BUCKETS))
    for r in land(counted, "quality-counts").collect():  # one row per bucket at most
        table[:, r["bucket"]] = r["trusted"], r["raw"]
    share = (table + SMOOTH) / (table + SMOOTH).sum(axis=1, keepdims=True)
    weights = spark.sparkContext.broadcast(np.log(share[0] / share[1]).tobytes())
    scored = land(rows.mapInArrow(_score(weights), "doc_id long, " + ", ".join(f"{f} long" for f in _FIELDS) + ", llr double"), "quality-scores")
    step = F.floor((F.greatest(F.lit(-4.0), F.least(F.lit(3.999), "llr")) + 4) * 512).cast("int")
    hist = scored.join(marks, "doc_id").groupBy(step.alias("step"), F.col("q").alias("q")).count().collect()  # 2 x 4,096 rows at most
    cut = threshold({(r["step"], int(r["q"] == 1)): r["count"] for r in hist})
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select("*", failed.alias("base_failed"), (~failed & (step >= F.lit(cut))).alias("kept"))


def threshold(counts: dict[tuple[int, int], int], steps: int = 4096) -> int:
    good, bad = (np.array([counts.get((i, q), 0) for i in range(steps)], float) for q in (1, 0))
    if not good.sum() or not bad.sum():
        return -1
    below = lambda x: np.concatenate([[0], np.cumsum(x)[:-1]]) / x.sum()
    return int(np.argmax(below(bad) - below(good)))


def op5_loglikelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface counts and the quality verdict of all documents."""
    out = quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", *_FIELDS, "base_failed", "kept", "llr")

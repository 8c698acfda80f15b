"""b-bit MinHash near-duplicates: banded candidates, collision-corrected estimates, exact confirmation."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, documents, id_array, id_text, land
from .components import components
from .words import doc_bounds, mix, span_hash, spans, window_hash

#: 40 bands of 5 rows: a pair of Jaccard similarity 0.8 shares no band with probability 1.3e-7.
BANDS, ROWS = 40, 5
#: Low bits kept of each minimum, and how far (in similarity) an estimate may lie below the threshold before the pair
#: is not confirmed: 5.5 standard errors of 200 four-bit comparisons at similarity 0.8.
BITS, MARGIN = 4, 0.16
#: Members of one bucket, and shingles of theirs, on one side of a cell (expected).
CELL, CELL_SHINGLES = 1024, 1_000_000
_A = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 31, (BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_C = np.random.Generator(np.random.PCG64(8)).integers(1, 1 << 63, (ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def shingles(block, k: int) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each document; a shorter word sequence is one shingle."""
    start, end, doc = spans(block)
    h = span_hash(block.data, start, end, lower=True)
    sh, at = window_hash(h, doc, k)
    cuts, words = np.searchsorted(doc[at], np.arange(block.n + 1)), doc_bounds(block.n, doc)
    out = []
    for i in range(block.n):
        n = words[i + 1] - words[i]
        if n >= k:
            out.append(np.unique(sh[cuts[i]:cuts[i + 1]]))
        elif n:
            one, _ = window_hash(h[words[i]:words[i + 1]], doc[words[i]:words[i + 1]], n)
            out.append(mix(one))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(s: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 8192):
        np.minimum(out, (_A * x[None, i:i + 8192]).min(axis=1), out=out)
    return out


def packed(m: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each (scrambled) minimum, two to a byte."""
    m = (m ^ (m >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    m = ((m ^ (m >> np.uint32(13))) & np.uint32(15)).astype(np.uint8)
    return (m[::2] << 4 | m[1::2]).tobytes()


def band_keys(m: np.ndarray) -> np.ndarray:
    g = (m.reshape(BANDS, ROWS).T.astype(np.uint64) * _C).sum(axis=0, dtype=np.uint64)
    return mix(g + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of packed signatures (rows of bytes), by bit counts of their difference."""
    x = a ^ b
    nib = x | x >> 1
    nib = (nib | nib >> 2) & 0x11
    same = 1 - _POP[nib].sum(axis=-1, dtype=np.int32) / (BANDS * ROWS)
    r = 2.0 ** -BITS
    return (same - r) / (1 - r)


def _sketch(k: int, full: bool):
    def run(batches):
        for block in blocks(batches):
            sets = shingles(block, k)
            cols = {"doc_id": id_array(block), "n": pa.array([len(s) for s in sets], pa.int64())}
            if full:
                cols["shingles"] = pa.array([s.tobytes() for s in sets], pa.binary())
            else:
                mins = [minima(s) if len(s) else None for s in sets]
                cols["same"] = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary())
                cols["sig"] = pa.array([None if m is None else packed(m) for m in mins], pa.binary())
                cols["bands"] = pa.array([None if m is None else band_keys(m) for m in mins], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(cols)
    return run


def _confirm(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            mask = pa.array([_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den) for x, y in zip(a, b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])
    return run


def _linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    at = np.searchsorted(x, y)
    both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return den * both >= num * (len(x) + len(y) - both)


def _cell_links(least: float, num: int, den: int):
    """Links that join different components within one cell of a bucket (or between two cells of it), confirmed on full sets.

    A pair belongs to the first band that it shares. Pairs that an earlier link of the cell has connected are not
    compared, so a cell gives fewer links than it has components."""
    def run(table: pa.Table) -> pa.Table:
        ids, comp, size, side, band = (table.column(c).to_numpy() for c in ("rep", "comp", "n", "side", "band"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        earlier = int(np.flatnonzero(bands[0] == band[0])[0])
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        a, b = [], []
        for i in left.tolist():
            ok = right[(comp[right] != comp[i]) & (num * np.maximum(size[right], size[i]) <= den * np.minimum(size[right], size[i]))]
            ok = ok[~(bands[ok, :earlier] == bands[i, :earlier]).any(axis=1)]
            if not len(ok):
                continue
            e = estimate(sig[ok], sig[i])
            for j in ok[np.argsort(-e, kind="stable")][:int((e >= least).sum())].tolist():
                if comp[j] != comp[i] and _linked(sets[i], sets[j], num, den):
                    a.append(max(ids[i], ids[j]))
                    b.append(min(ids[i], ids[j]))
                    comp = np.where(comp == comp[j], comp[i], comp)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; two documents are linked when their sets of distinct
    ``k``-word shingles reach ``den * intersection >= num * union``; a component is named by its smallest ``doc_id``.
    Null or empty text: empty set, linked with nothing. A null ``doc_id`` is returned as it is, linked with nothing and
    kept. Repeated rows of one ``doc_id`` are one vertex of the graph (any of its texts links it) and come back as
    often as they came; equal sets always link, whatever their order. Extra columns are ignored; an empty table gives an empty result.

    1. Each document's set gives 200 minima: bands of their full values, and a packed signature of their low bits.
       Equal sets collapse into one class, named by its smallest id, before any bucket is formed.
    2. A bucket (a band value shared by two classes or more) links each member with the bucket's smallest id. The best
       such link of each class is confirmed on full sets if the signature's estimate allows it, and components form.
    3. Buckets that still hold several components compare the members of different components, by signatures, in
       cells of about 1,024 x 1,024; a pair whose estimate reaches the threshold less the margin is confirmed on full sets unless a link
       has connected its components before. No candidate is dropped otherwise; cells return links, never pairs."""
    least = num / den - MARGIN
    rows = id_text(docs, id_col, text_col)
    base = land(rows.mapInArrow(_sketch(k, False), "doc_id long, n long, same binary, sig binary, bands array<long>"), "mh-sketch")
    valid = base.where("same is not null and doc_id is not null")
    classes = land(valid.groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "mh-classes")

    members = classes.select("rep", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("rep").alias("center"), F.max("rep").alias("top")).where("center <> top").select("band", "center")
    crowd = land(members.join(buckets, "band"), "mh-crowd")
    tiny = classes.select("rep", "n", "sig")
    star = crowd.where("rep <> center").groupBy("rep", "center").agg(F.count("*").alias("c"))
    best = star.groupBy("rep").agg(F.min_by("center", F.struct(-F.col("c"), "center")).alias("center"))
    pairs = _estimated(best.select(F.col("rep").alias("a"), F.col("center").alias("b")), tiny, least)

    wanted = crowd.select("rep").distinct()
    sets = land(rows.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
                .mapInArrow(_sketch(k, True), "doc_id long, n long, shingles binary").where("n > 0"), "mh-sets")
    # One id may come with several texts; the class rows say which set the id stands for.
    keyed = sets.groupBy("doc_id", "n", "shingles").agg(F.lit(1).alias("x")).select(F.col("doc_id").alias("rep"), "shingles")
    first = land(_confirmed(pairs, keyed, num, den), "mh-first")
    comp = components(first, "mh-cc1")

    named = crowd.join(comp.select(F.col("v").alias("rep"), "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    whole = classes.select("rep", "n", "sig", "bands").join(keyed, "rep").where(F.octet_length("shingles") == 8 * F.col("n"))
    mixed = (named.join(tiny.select("rep", "n"), "rep").groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), F.sum("n").alias("n")).where("lo <> hi")
             .select("band", F.greatest(F.ceil(F.col("size") / CELL), F.ceil(F.col("n") / CELL_SHINGLES)).cast("int").alias("cells")))
    rest = named.join(mixed, "band").join(whole, "rep").select("band", "cells", "rep", "comp", "n", "sig", "bands", "shingles", F.pmod(F.xxhash64("rep"), F.col("cells")).cast("int").alias("cell"))
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other")
    spread = rest.select("*", other).select(
        "band", "rep", "comp", "n", "sig", "bands", "shingles", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"),
        F.when(F.col("cell") == F.col("other"), 0).when(F.col("cell") < F.col("other"), 1).otherwise(2).alias("side"))
    second = land(spread.groupBy("band", "i", "j").applyInArrow(_cell_links(least, num, den), "a long, b long").distinct(), "mh-second")
    links = first.unionByName(second).unionByName(
        # a doc_id whose texts fall in several classes joins them
        valid.join(classes.select("same", "rep"), "same").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = components(links, "mh-cc2")
    out = base.select("doc_id", F.col("n").alias("n_shingles")).join(final.select(F.col("v").alias("doc_id"), "comp"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"),
                      F.coalesce(F.col("comp") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _estimated(pairs: DataFrame, tiny: DataFrame, least: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
                keep = pa.array(estimate(x, y) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    left, right = (tiny.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    left, right = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"s_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b").mapInArrow(_confirm(num, den), "a long, b long").distinct()


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the documents that a smaller id's component holds; rows that repeat
    an id stay or go together. Only the ids that go are joined."""
    gone = near_duplicates(docs, k, num, den).where("not kept").select("doc_id").distinct()
    return docs.join(land(gone, "mh-gone"), "doc_id", "left_anti").select(*docs.columns)


def op10_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on 2-word shingles at 0.8."""
    return near_duplicates(documents(spark, sf_dir), k=2)

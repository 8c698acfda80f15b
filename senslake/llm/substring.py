"""Substring removal across documents by level-wise doubling of repeated word windows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Block, blocks, documents, id_text, land, long_ids
from .words import doc_bounds, mix, span_hash, spans, window_hash

#: No level is shorter than this many words (but for windows that are): shorter sequences repeat nearly everywhere.
SHORTEST = 4
#: Bits of the sieve that carries a level's repeated sequences to the next (32 MiB). It only saves work: a seed that
#: meets a foreign bit costs one more window to compare, none is lost.
SIEVE_BITS = 28
#: Seeds and windows are compared in slices of their hashes: 2 ** 9 at least, and as many as keep the text of a slice
#: below this size (expected), so that no group grows with the corpus.
LEAST_SLICE_BITS, SLICE_BYTES = 9, 1 << 26


def levels(window: int) -> list[int]:
    """Lengths of the levels, each at most twice the one before: 4, 7, 13 for windows of 13 words."""
    out = [window]
    while (out[0] + 1) // 2 >= SHORTEST:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _least(h: np.ndarray, doc: np.ndarray, begin: np.ndarray, longer: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each sequence of ``longer`` words from ``begin`` the ``length``-word part of least hash: its place and hash."""
    value, at = window_hash(h, doc, length)
    full = np.zeros(len(h), np.uint64)
    full[at] = value
    pick = begin.copy()
    low = full[pick]
    for j in range(1, longer - length + 1):
        here = full[begin + j]
        less = here < low
        pick[less], low[less] = begin[less] + j, here[less]
    return pick, low


def _held(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit in the sieve."""
    bit = hashes >> np.uint64(64 - SIEVE_BITS)
    return (sieve[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1 == 1


def _level(block: Block, lengths: list[int], level: int, sieve: np.ndarray | None):
    """Words' documents and hashes, and (places, hashes) of the sequences of one level that may repeat.

    A full window names its part of least hash one level down, that part names its own, and so on: equal windows name
    equal parts on every level. A sequence is held if the part that it names one level down is in that level's ``sieve``
    (all, on the first level). On the last level the hashes are left out."""
    start, end, doc = spans(block)
    h = span_hash(block.data, start, end)
    n = len(h) - lengths[-1] + 1
    at = np.flatnonzero(doc[:n] == doc[lengths[-1] - 1:]) if n > 0 else np.zeros(0, np.int64)
    value = None
    for i in range(len(lengths) - 2, level - 1, -1):
        at, value = _least(h, doc, at, lengths[i + 1], lengths[i])
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        at, value = at[new], value[new]
    if sieve is not None and len(at):
        hit = _held(sieve, _least(h, doc, at, lengths[level], lengths[level - 1])[1])
        at, value = at[hit], None if value is None else value[hit]
    return doc, h, at, value


def _first_two(seeds: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each seed's distinct documents the smallest and the largest: enough to tell whether there are two."""
    order = np.lexsort((docs, seeds))
    s, d = seeds[order], docs[order]
    if not len(s):
        return s, d
    edge = np.ones(len(s), bool)
    edge[1:] = s[1:] != s[:-1]
    last = np.ones(len(s), bool)
    last[:-1] = edge[1:]
    keep = edge | (last & (d != d[np.flatnonzero(edge)][np.cumsum(edge) - 1]))
    return s[keep], d[keep]


def _planes(rows: np.ndarray) -> bytes:
    """Rows as bytes, all first bytes, then all second ones: the zero bytes of small numbers lie together and compress."""
    return np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), rows.dtype.itemsize).T.tobytes()


def _from_planes(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def _slice_bits(rows: DataFrame, slice_bytes: int) -> int:
    """Leading hash bits that number the slices; a slice fills one byte of the sieve at least."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(SIEVE_BITS - 3, max(LEAST_SLICE_BITS, (size // slice_bytes).bit_length()))


def _cuts(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the slices that occur in sorted ``hashes``, and where each begins, with the end."""
    s = (hashes >> hashes.dtype.type(8 * hashes.itemsize - k)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[first], np.append(first, len(s))


def _seed_rows(lengths: list[int], level: int, sieve, k: int):
    """(slice, seeds, docs) of one level as packed arrays; each task keeps two documents of a seed at most.

    A seed is the upper half of its hash: the sieve holds fewer bits than that, and two that share it cost no repeat."""
    def run(batches):
        bits = None if sieve is None else np.frombuffer(sieve.value, np.uint8)
        have = [np.zeros(0, np.uint32), np.zeros(0, np.int64)]
        fresh: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def fold():
            have[:] = _first_two(np.concatenate([have[0], *(x for x, _ in fresh)]), np.concatenate([have[1], *(y for _, y in fresh)]))
            fresh.clear()

        def out():
            some, cut = _cuts(have[0], k)
            return pa.RecordBatch.from_pydict({
                "slice": pa.array(some, pa.int32()),
                "seeds": pa.array([_planes(have[0][a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                "docs": pa.array([_planes(have[1][a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

        for block in blocks(batches):
            doc, _, at, value = _level(block, lengths, level, bits)
            if len(at):
                fresh.append(((value >> np.uint64(32)).astype(np.uint32), long_ids(block)[doc[at]]))
                size += len(at)
            if size > 400_000:
                fold()
                size = 0
                if len(have[0]) > 1_000_000:
                    yield out()
                    have[:] = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        fold()
        if len(have[0]):
            yield out()
    return run


def _sieve(k: int):
    """Bits of one slice: seeds that start in two documents or more."""
    def run(table: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.concatenate([_from_planes(x, kind) for c in table.column(name).chunks for x in c.to_pylist()])
        s, _ = _first_two(joined("seeds", np.uint32), joined("docs", np.int64))
        twice = s[1:][s[1:] == s[:-1]]
        bits = np.zeros(1 << (SIEVE_BITS - k), np.uint8)
        bits[(twice >> np.uint32(32 - SIEVE_BITS)).astype(np.int64) & ((1 << (SIEVE_BITS - k)) - 1)] = 1
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})
    return run


def _runs(at: np.ndarray, window: int) -> bytes:
    """Sorted window starts as (first word, end word) runs of the words that they cover."""
    if not len(at):
        return b""
    cut = np.flatnonzero(np.diff(at) > window) + 1
    first = np.concatenate([at[:1], at[cut]])
    last = np.concatenate([at[cut - 1], at[-1:]]) + window
    return np.stack([first, last], 1).astype(np.int32).tobytes()


_FOUND = "kind int, slice int, doc long, same long, payload binary"


def _candidates(lengths: list[int], sieve, k: int):
    """Full windows with a repeated part (all, without a level below), compared within the task first.

    kind 0: (slice, packed windows: hash, hash, document, text key, start) of the smallest document that the task knows
    of; kind 1: (document, covered runs) where the task itself holds the same window in a smaller document."""
    window = lengths[-1]

    def run(batches):
        bits = None if sieve is None else np.frombuffer(sieve.value, np.uint8)

        def emit(parts):
            h1, h2, doc, same, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((at, same, doc, h2, h1))
            h1, h2, doc, same, at = (x[order] for x in (h1, h2, doc, same, at))
            edge = np.ones(len(h1), bool)
            edge[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            least = doc[np.flatnonzero(edge)][np.cumsum(edge) - 1]
            mine = doc == least
            kept = _once(np.rec.fromarrays([h1[mine], h2[mine], doc[mine], same[mine], at[mine]], dtype=_REC))
            some, cut = _cuts(kept["h1"], k)
            yield _batch(0, some, None, None, [_planes(kept[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)])
            yield from _by_document(doc[~mine], same[~mine], at[~mine], window)

        parts, size = [], 0
        for block in blocks(batches):
            doc, h, at, _ = _level(block, lengths, len(lengths) - 1, bits)
            if len(at):
                h1, h2 = _pair_hash(h, at, window)
                base = doc_bounds(block.n, doc)
                same = block.rows.column(block.rows.schema.get_field_index("same")).to_numpy(zero_copy_only=False)
                parts.append((h1, h2, long_ids(block)[doc[at]], same[doc[at]], (at - base[doc[at]]).astype(np.int32)))
                size += len(at)
            if size > 1_000_000:
                yield from emit(parts)
                parts, size = [], 0
        if parts:
            yield from emit(parts)
    return run


_REC = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("same", "<i8"), ("at", "<i4")])


def _once(rec: np.ndarray) -> np.ndarray:
    """Sorted rows without repeats: copies of one row (same id, same text) name each window once."""
    new = np.ones(len(rec), bool)
    new[1:] = np.logical_or.reduce([rec[c][1:] != rec[c][:-1] for c in rec.dtype.names])
    return rec[new]


def _pair_hash(h: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window from word hashes under two multipliers."""
    a, b = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for j in range(window):
        w = h[at + j]
        a = a * np.uint64(0x9E3779B97F4A7C15) + w
        b = b * np.uint64(0xC2B2AE3D27D4EB4F) + (w ^ (w >> np.uint64(29)))
    return mix(a), mix(b)


def _batch(kind, slices, docs, sames, payload) -> pa.RecordBatch:
    n = len(payload)
    return pa.RecordBatch.from_pydict({
        "kind": pa.array([kind] * n, pa.int32()), "slice": pa.array(slices if slices is not None else [None] * n, pa.int32()),
        "doc": pa.array(docs if docs is not None else [None] * n, pa.int64()),
        "same": pa.array(sames if sames is not None else [None] * n, pa.int64()), "payload": pa.array(payload, pa.binary())})


def _by_document(doc, same, at, window):
    if not len(doc):
        return
    order = np.lexsort((at, same, doc))
    doc, same, at = doc[order], same[order], at[order]
    cut = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (same[1:] != same[:-1])) + 1, [len(doc)]])
    yield _batch(1, None, doc[cut[:-1]], same[cut[:-1]], [_runs(at[a:b], window) for a, b in zip(cut[:-1], cut[1:], strict=True)])


def _judge(window: int):
    """Runs of the windows of one slice that also start in a smaller document."""
    def run(table: pa.Table) -> pa.Table:
        rec = np.concatenate([_from_planes(x, _REC) for c in table.column("payload").chunks for x in c.to_pylist()])
        order = np.lexsort((rec["doc"], rec["h2"], rec["h1"]))
        h1, h2, doc = rec["h1"][order], rec["h2"][order], rec["doc"][order]
        edge = np.ones(len(h1), bool)
        edge[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        late = doc != doc[np.flatnonzero(edge)][np.cumsum(edge) - 1]
        rows = list(_by_document(doc[late], rec["same"][order][late], rec["at"][order][late], window))
        if not rows:
            return pa.table({"doc": pa.array([], pa.int64()), "same": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})
        return pa.Table.from_batches(rows).select(["doc", "same", "payload"])
    return run


def _strip(batches):
    for block in blocks(batches):
        start, end, doc = spans(block)
        bound = doc_bounds(block.n, doc)
        runs = block.rows.column(block.rows.schema.get_field_index("runs")).to_pylist()
        total, gone, sha, texts = [], [], [], []
        for i in range(block.n):
            a, b = bound[i], bound[i + 1]
            cover = np.zeros(b - a + 1, np.int64)
            for r in runs[i] or ():
                r = np.frombuffer(r, np.int32).reshape(-1, 2)
                np.add.at(cover, r[:, 0], 1)
                np.add.at(cover, r[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
            words = block.text(i).split()
            text = b" ".join(words) if len(kept) == len(words) else b" ".join([words[j] for j in kept.tolist()])
            total.append(b - a)
            gone.append(b - a - len(kept))
            sha.append(hashlib.sha256(text).hexdigest())
            texts.append(text)
        yield pa.RecordBatch.from_arrays([block.rows.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text): every document without the words that a ``window``-word
    sequence covers which also starts in a document with a smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; ``kept_text`` joins what is left by one space. Null or empty text has no words. A null ``doc_id`` counts as
    larger than every other (all null ids as one document). Rows that repeat an id are one document: they never remove
    from each other, and each comes back. Extra columns are ignored; an empty table gives an empty result.

    The levels double: 4, 7 and 13 words for a window of 13 (:func:`levels`). On each, a window is stood for by its part of
    least hash, that of the part of least hash one level up, so equal windows name equal parts and few parts are compared.
    A level sees only the parts whose own part one level down was found in two documents (a 32 MiB sieve carries those);
    of each it groups two documents per task at most, so a passage in every document costs a row per task. The loop ends
    when no part of a level is in two documents: then nothing repeats.
    Last level: the windows left are compared by 128-bit hashes, within the task first, then one row per task, sequence and
    text of its smallest document by hash: rows repeated as they are cost nothing. Covered words return to their documents as runs.
    All levels compare in slices of the hashes, whose number grows with the text (``slice_bytes`` of it a slice)."""
    rows = id_text(docs, id_col, text_col).select("*", F.xxhash64("text").alias("same"))
    spark = docs.sparkSession
    k = _slice_bits(rows, slice_bytes)
    lengths, sieve = levels(window), None
    for level in range(len(lengths) - 1):
        seeds = rows.select("doc_id", "text").mapInArrow(_seed_rows(lengths, level, sieve, k), "slice int, seeds binary, docs binary")
        found = land(seeds.groupBy("slice").applyInArrow(_sieve(k), "slice int, bits binary"), "sub-sieve")
        bits = np.zeros(1 << (SIEVE_BITS - 3), np.uint8)
        width = len(bits) >> k
        for r in found.toLocalIterator():  # fixed size: 32 MiB over all slices
            bits[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
        if not bits.any():
            return rows.select("doc_id", "text", F.lit(None).cast("array<binary>").alias("runs")).mapInArrow(_strip, _KEPT)
        sieve = spark.sparkContext.broadcast(bits.tobytes())
    cand = land(rows.mapInArrow(_candidates(lengths, sieve, k), _FOUND), "sub-windows")
    judged = cand.where("kind = 0").groupBy("slice").applyInArrow(_judge(window), "doc long, same long, payload binary")
    marks = land(cand.where("kind = 1").select("doc", "same", "payload").unionByName(judged).groupBy("doc", "same").agg(F.collect_set("payload").alias("runs")), "sub-marks")
    top = F.lit(int(np.iinfo(np.int64).max))
    joined = rows.select("doc_id", "text", F.coalesce("doc_id", top).alias("doc"), "same").join(marks, ["doc", "same"], "left")
    return joined.select("doc_id", "text", "runs").mapInArrow(_strip, _KEPT)


def op9_level_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 13-word passages that an earlier document holds, removed from all documents."""
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")

"""Benchmark decontamination: q-gram counting in overlapping diagonal bands, then banded alignment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, documents, id_array, id_text
from .words import HEAD, mix

Q = 7
#: (length, stride, edits allowed per character) of the overlapping patterns that items are cut into: long ones, and short ones for quotes of a
#: part and denser edits.
CUTS = ((200, 100, 0.08), (80, 40, 0.12))
#: Diagonals per band (each also takes the next ``budget`` ones), item characters broadcast at once, and searched at once (worker memory).
BAND, BLOCK_CHARS, PART_CHARS = 64, 2_000_000, 50_000
#: Shorter items match nothing.
LEAST = 10
_FILTER_BITS = 22
#: Counters of the first count, of shared q-grams per document, item and wide band; pairs that share a counter only pass too often.
_COUNTERS = 1 << 19
#: Pairs of a document and a pattern that are counted in one table.
_PAIRS = 1 << 23


def normal(data: np.ndarray, offs: np.ndarray):
    """Code points with ASCII and Latin-1 case folded and white space runs made one space: (characters, document offsets, places in the text)."""
    text = data.tobytes().decode("utf-8", "replace")
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
    place = np.concatenate([[0], np.cumsum(HEAD[data])])[offs]
    upper = (chars >= 65) & (chars <= 90) | (chars >= 0xC0) & (chars <= 0xDE) & (chars != 0xD7)
    chars[upper] += 32
    space = (chars == 32) | (chars >= 9) & (chars <= 13) | (chars == 0xA0)
    chars[space] = 32
    keep = np.ones(len(chars), bool)
    if len(chars):
        keep[1:] = ~(space[1:] & space[:-1])
    at = np.flatnonzero(keep)
    return chars[at], np.searchsorted(at, place), at


def grams(chars: np.ndarray) -> np.ndarray:
    """Hashes of all q-grams, by doubling: pairs, fours, and the last three."""
    n = len(chars) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    k, k2, k3 = (np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in (1, 2, 3))
    c = chars.astype(np.uint64)
    two = c[:-1] * k + c[1:]
    four = two[:-2] * k2 + two[2:]
    three = two[:-1] * k + c[2:]
    return mix(four[:n] * k3 + three[4:4 + n])


def budget(m: int) -> int:
    """Edits allowed: the rate of the shortest cut that takes the length, lowered until the q-gram lemma asks for one shared q-gram at least."""
    rate = next(r for length, _, r in sorted(CUTS) if m <= length)
    return max(0, min(int(rate * m), m // Q - 1))


class Patterns:
    """Patterns of some items and the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.chars, self.item, begin, whole = [], [], [], []
        for number, (item, text) in enumerate(items):
            raw = np.frombuffer(text.strip().encode(), np.uint8)
            c, _, _ = normal(raw, np.array([0, len(raw)]))
            spans = set()
            for length, stride, _ in CUTS:
                last = max(len(c) - length, 0)
                spans |= {(a, min(a + length, len(c))) for a in (*range(0, last + 1, stride), last)}
            if len(c) >= LEAST:
                self.chars += [c[a:b] for a, b in sorted(spans)]
                self.item += [item] * len(spans)
                begin += [(number, a) for a, _ in sorted(spans)]
            whole.append(c)
        self.size = np.array([len(c) for c in self.chars], np.int64)
        self.edits = np.array([budget(m) for m in self.size.tolist()], np.int64)
        self.need = self.size + 1 - Q * (self.edits + 1)
        # The index holds each place of each item once; the patterns over a place are looked up for the few that matter.
        sizes = np.array([len(c) for c in whole], np.int64)
        base = np.cumsum(sizes) - sizes
        number, self.begin = np.array(begin, np.int64).reshape(-1, 2).T
        n = np.maximum(self.size - Q + 1, 0)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        over = np.repeat(base[number] + self.begin, n) + at if len(n) else at
        by = np.argsort(over, kind="stable")
        self.over_pattern, self.over_at = np.repeat(np.arange(len(n)), n)[by], at[by]
        self.over_first = np.searchsorted(over[by], np.arange(int(sizes.sum()) + 1))
        least = np.full(len(whole), np.iinfo(np.int64).max // 2)
        np.minimum.at(least, number, np.maximum(self.need, 1))
        h = [grams(c) for c in whole]
        g = np.concatenate([np.zeros(0, np.uint64), *h])
        item = np.repeat(np.arange(len(h)), [len(x) for x in h]) if h else np.zeros(0, np.int64)
        pos = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in h)])
        order = np.argsort(g, kind="stable")
        order = order[np.diff(self.over_first)[(base[item] + pos)[order]] > 0] if len(order) else order
        self.gram, self.first = np.unique(g[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.of, self.pos, self.place, self.least = item[order], pos[order], (base[item] + pos)[order] if len(order) else order, least
        self.wide = BAND + int(self.edits.max(initial=0))
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[(self.gram >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, g: np.ndarray, offs: np.ndarray):
        """(document, pattern, diagonal, place in the pattern) of every shared q-gram of the text's ``g`` that lies inside one document."""
        t = np.flatnonzero(self.bits[(g >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = np.searchsorted(self.gram, g[t])
        ok = at < len(self.gram)
        ok[ok] = self.gram[at[ok]] == g[t][ok]
        t, at = t[ok], at[ok]
        doc = np.searchsorted(offs, t, "right") - 1
        ok = t + Q <= offs[doc + 1]
        t, at, doc = t[ok], at[ok], doc[ok]
        n = self.first[at + 1] - self.first[at]
        k = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc, t = np.repeat(doc, n), np.repeat(t - offs[doc], n)
        keep = self._crowded(doc, self.of[k], t - self.pos[k])
        doc, t, place = doc[keep], t[keep], self.place[k[keep]]
        n = self.over_first[place + 1] - self.over_first[place]
        k = np.repeat(self.over_first[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(doc, n), self.over_pattern[k], np.repeat(t, n) - self.over_at[k], self.over_at[k]

    def _crowded(self, doc: np.ndarray, item: np.ndarray, diag: np.ndarray) -> np.ndarray:
        """Hits that may be among the q-grams of a match: a match's diagonals lie in two neighbouring wide bands, which then hold as many
        hits as the item's least demanding pattern asks for. Counters are shared by hash, so they never fall below the counts."""
        band = np.floor_divide(diag, self.wide)
        pair = mix((doc * len(self.least) + item).astype(np.uint64))
        k2, mask = np.uint64(0x9E3779B97F4A7C15), np.uint64(_COUNTERS - 1)

        def slot(b):
            h = pair + b.astype(np.uint64) * k2
            return ((h ^ (h >> np.uint64(29))) & mask).astype(np.int64)
        here = slot(band)
        count = np.bincount(here, minlength=_COUNTERS)
        beside = np.maximum(count[slot(band - 1)], count[slot(band + 1)])
        return np.flatnonzero(count[here] + beside >= self.least[item])


def align(pattern: np.ndarray, text: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the occurrences of ``pattern`` in ``text`` with ``k`` edits at most: every exact one, and, best (then first) end
    first, those that overlap none found so far.

    ``text`` is the band's window, so the whole table is the band: one row per pattern character, insertions by a running minimum."""
    n = len(text)
    j = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), j.copy()
    big = np.int64(1 << 20)
    for i, c in enumerate(pattern):
        diag = cost[:-1] + (text != c)
        up = cost[1:] + 1
        pick = diag <= up
        cand = np.concatenate([[cost[0] + 1], np.where(pick, diag, up)])
        from_ = np.concatenate([[start[0]], np.where(pick, start[:-1], start[1:])])
        key = (cand - j) * big + j  # the running minimum also tells where it came from
        run = np.minimum.accumulate(key)
        src = run % big
        cost, start = cand[src] + (j - src), from_[src]
        if cost.min() > k:
            return []
    out = []
    for e in sorted(np.flatnonzero((cost <= k) & (start < j)).tolist(), key=lambda e: (cost[e], e)):
        a = int(start[e])
        if not cost[e] or not any(a < y and x < e for _, x, y in out):
            out.append((int(cost[e]), a, e))
    return out


def _exact(pattern: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """As :func:`align` with no edits."""
    out, p, t = [], pattern.tobytes(), text.tobytes()
    at = t.find(p)
    while at >= 0:
        if at % 4 == 0:
            out.append((0, at // 4, at // 4 + len(pattern)))
        at = t.find(p, at + 1)
    return out


def _matches(p: Patterns, chars: np.ndarray, offs: np.ndarray, g: np.ndarray):
    """(document, pattern, start, end, edits) of every occurrence of a pattern; places count in ``chars``."""
    doc, pat, diag, at = p.hits(g, offs)
    if (len(offs) - 1) * len(p.size) <= _PAIRS:  # most pairs share too few q-grams on all bands together
        pair = doc * len(p.size) + pat
        enough = np.bincount(pair)[pair] >= p.need[pat]
        doc, pat, diag, at = doc[enough], pat[enough], diag[enough], at[enough]
    if not len(doc):
        return
    low = np.floor_divide(diag, BAND)
    two = diag - low * BAND < p.edits[pat]
    # one number for (document, pattern, band)
    least, span = int(low.min()) - 1, int(low.max() - low.min()) + 2
    key = (doc * len(p.size) + pat) * span + (low - least)
    key, diag, at = (np.concatenate([x, y[two]]) for x, y in ((key, key - 1), (diag, diag), (at, at)))
    cand, count = np.unique(key, return_counts=True)
    cand = cand[count >= p.need[cand // span % len(p.size)]]
    # the lemma's q-grams stand at different places of the pattern and of the text: one that is often repeated counts once
    back = np.searchsorted(cand, key)
    use = np.flatnonzero(np.append(cand, -1)[back] == key)
    back, diag, at = back[use], diag[use], at[use]
    need, enough = p.need[cand // span % len(p.size)], np.ones(len(cand), bool)
    for place in (at, diag + at):
        width = int(place.max(initial=0)) + 1
        enough &= np.bincount(np.unique(back * width + place) // width, minlength=len(cand)) >= need
    key = cand[enough]
    band, pat, doc = key % span + least, key // span % len(p.size), key // span // len(p.size)
    m, k = p.size[pat], p.edits[pat]
    a = offs[doc] + np.maximum(0, band * BAND - k)
    z = np.minimum(offs[doc + 1], offs[doc] + (band + 1) * BAND + m + 3 * k)
    ok = z - a >= m - k
    doc, pat, m, k, a, z = (x[ok] for x in (doc, pat, m, k, a, z))
    for i in range(len(doc)):
        pattern, window = p.chars[pat[i]], chars[a[i]:z[i]]
        # occurrences that do not overlap start m - k apart at least: only in short patterns' bands can one more stand beside an exact one
        found = _exact(pattern, window) if m[i] - k[i] >= BAND else []
        for edits, x, y in found or align(pattern, window, int(k[i])):
            yield int(doc[i]), int(pat[i]), int(a[i]) + x, int(a[i]) + y, edits


def _regions(parts: list[Patterns], block) -> list[tuple[int, int, int, int, int]]:
    """(document index, item, start, end, edits) of every match in a block."""
    chars, offs, place = normal(block.data, block.offs)
    begins = np.concatenate([[0], np.cumsum(HEAD[block.data])])[block.offs]
    g, rows = grams(chars), []
    for p in parts:
        for d, q, x, y, edits in _matches(p, chars, offs, g):
            end = place[y] if y < len(place) and y < offs[d + 1] else begins[d + 1]
            rows.append((d, p.item[q], int(place[x] - begins[d]), int(end - begins[d]), (-int(p.size[q]), edits)))
    return _merged(rows)


def _search(shared):
    def run(batches):
        for block in blocks(batches):
            rows = _regions(shared.value, block)
            ids = id_array(block)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array([r[0] for r in rows], pa.int64())), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(1, 5))],
                                             ["doc_id", "item_id", "start", "end", "edits"])
    return run


def _merged(rows):
    """Overlapping or touching matches of one item in one document as one region, with the edits of its longest (then best) pattern."""
    out = []
    for r in sorted(set(rows)):
        if out and out[-1][:2] == r[:2] and r[2] <= out[-1][3]:
            out[-1] = (*out[-1][:3], max(out[-1][3], r[3]), min(out[-1][4], r[4]))
        else:
            out.append(r)
    return [(*r[:4], r[4][1]) for r in out]


def _parts(block: list[tuple[int, str]]) -> list[Patterns]:
    """Patterns of a block of items, by PART_CHARS characters of them."""
    cut = (np.cumsum([len(t) for _, t in block]) - 1) // PART_CHARS
    return [Patterns([x for x, c in zip(block, cut, strict=True) if c == part]) for part in np.unique(cut)]


def _item_blocks(items: DataFrame):
    block, size = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        block.append((r["item_id"], r["text"]))
        size += len(r["text"])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end, edits): every region of a document that holds a benchmark item, or a pattern cut from it. Patterns are 200
    characters at a stride of 100, within 8 edits in 100 characters, and 80 at a stride of 40 (the last of each flush with the end), within 12
    edits in 100; so a verbatim quote of 101 characters of any item is found, and so are its first and its last 71. Offsets are code points of the
    given text, ends exclusive; ``edits`` are those of the longest pattern found.

    Case (ASCII, Latin-1) and white space runs do not count. A pattern of m characters and k edits shares m + 1 - q (k + 1) q-grams (q = 7)
    with any such region, on k + 1 neighbouring diagonals; bands that reach this count are compared, so no pattern is missed. Shorter quotes, and
    edits that are denser in every pattern, are not looked for. Items of fewer than 10
    characters and null items match nothing; patterns shorter than 14 characters are matched exactly. Null and empty texts match nothing; null ids stay null; repeated rows are reported
    as often as they come. Extra columns are ignored; empty tables give an empty result.

    Items reach the workers in blocks of 2,000,000 characters, each against all documents."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    schema = "doc_id long, item_id long, start long, end long, edits long"
    out = None
    for block in _item_blocks(items):
        shared = spark.sparkContext.broadcast(_parts(block))
        found = rows.mapInArrow(_search(shared), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def _clean(shared):
    def run(batches):
        for block in blocks(batches):
            keep = np.ones(block.n, bool)
            keep[[r[0] for r in _regions(shared.value, block)]] = False
            yield block.rows.filter(pa.array(keep))
    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the documents that :func:`contamination` reports; no join, no shuffle."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    for block in _item_blocks(items):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(_parts(block))), docs.schema)
    return docs


def op2_qgram_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

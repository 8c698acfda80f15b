"""Words of whole texts as numpy arrays: a word is a run of bytes other than space and \\x09-\\x0D."""

from __future__ import annotations

import numpy as np

from .common import Block

_MASK = (1 << 64) - 1


def _table(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that begin a code point.
HEAD = (np.arange(256) & 0xC0) != 0x80
_SEEDS = {0: (_table(11), 0x9E3779B97F4A7C15), 1: (_table(23), 0xD6E8FEB86659FD93)}
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get(which)
    if have is None or len(have[0]) < n:
        p = _SEEDS[which][1]
        size = 1 << max(20, int(n - 1).bit_length())
        up, down = np.full(size, p, np.uint64), np.full(size, pow(p, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = np.cumprod(up), np.cumprod(down)
        if size <= 1 << 21:
            _POW[which] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over random byte values, from one prefix sum, with the length mixed in."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(which, len(data) + 1)
    table = _SEEDS[which][0]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((table[_LOWER] if lower else table)[data] * up[:len(data)], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def spans(block: Block, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of each maximal run of bytes outside ``sep`` within one document."""
    data, offs = block.data, block.offs
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~sep[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def window_hash(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start index) of each window of ``k`` consecutive words of one document."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[at + j]
    return mix(out + np.uint64(k)), at


def per_doc(n_docs: int, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, n_docs).astype(np.int64)


def doc_bounds(n_docs: int, doc: np.ndarray) -> np.ndarray:
    """Word index at which each document begins, and the end."""
    return np.searchsorted(doc, np.arange(n_docs + 1))

"""Token ids of whole texts with a public tokenizer, words cached inside the worker."""

from __future__ import annotations

import os
from functools import cache

import numpy as np

from .common import Block
from .words import SPACE, span_hash

#: End-of-document id, appended to every document.
END = 1
#: Spans kept by one worker at most; beyond it the cache starts anew.
CACHE_SPANS = 1_500_000
#: Longer spans are encoded without the cache.
LONGEST = 64

_KIND = np.full(256, 3, np.uint8)
_KIND[SPACE] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = 2


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def cut(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that the tokenizer never joins: it drops white space and never merges ASCII letters with ASCII punctuation
    other than the apostrophe (its contractions begin with one)."""
    kind = _KIND[block.data]
    n = len(kind)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[block.offs] = True
    edge[1:-1] |= ((kind[1:] ^ kind[:-1]) == 3) & (kind[1:] != 0) & (kind[:-1] != 0) | ((kind[1:] == 0) != (kind[:-1] == 0))
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    word = kind[start] != 0
    start, end = start[word], end[word]
    return start, end, np.searchsorted(block.offs, start, "right") - 1


class Encoder:
    """Encodes blocks of documents; each distinct span goes through the tokenizer once per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self._clear()

    def _clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)

    def _add(self, keys: np.ndarray, texts: list[str]):
        if len(self.keys) > CACHE_SPANS:
            self._clear()
        got = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.array([len(x) for x in got], np.int32)
        flat = np.array([i for x in got for i in x], np.uint32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used:self.used + len(flat)] = flat
        first = self.used + np.cumsum(count) - count
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = (np.insert(a, at, b) for a, b in ((self.keys, keys), (self.first, first), (self.count, count)))

    def block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents with their end ids, number of ids of each document)."""
        start, end, doc = cut(block)
        long = end - start > LONGEST
        data = block.data
        odd = np.zeros(block.n, bool)  # documents that go through the tokenizer as a whole
        odd[doc[long]] = True
        # Special-token strings, and combining marks (letters compose with them before they are lower-cased).
        marks = np.flatnonzero((data == 0xCC) | (data == 0xCD))
        bars = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) else marks
        for at in (marks, bars):
            odd[np.searchsorted(block.offs, at, "right") - 1] = True
        if odd.any():
            keep = ~odd[doc]
            start, end, doc = start[keep], end[keep], doc[keep]
        uniq, some, back = np.unique(span_hash(data, start, end, lower=True), return_index=True, return_inverse=True)
        if len(self.keys) + len(uniq) > CACHE_SPANS:
            self._clear()
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            self._add(uniq[new], [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[some[new]].tolist(), end[some[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, uniq)
        count, first = self.count[at][back].astype(np.int64), self.first[at][back]
        ids = self.ids[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        n = np.bincount(doc, count, block.n).astype(np.int64)
        ends = np.cumsum(n)
        if odd.any():
            parts = np.split(ids, ends[:-1])
            for i in np.flatnonzero(odd).tolist():
                parts[i] = self.whole(block.text(i))
                n[i] = len(parts[i])
            ids, ends = np.concatenate(parts), np.cumsum(n)
        return np.insert(ids, ends, END).astype(np.uint32), n + 1


@cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)

"""Hard negatives against a full scan."""

import collections
import math

import numpy as np
import pytest

from senslake.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, shard int, cell string, q int, row long"


def brute(rows, chosen, k=5, m=3):
    dims = collections.Counter(len(q) for _, _, q in rows)
    dim = max(dims, key=lambda d: (dims[d], d))
    rows = [r for r in rows if len(r[2]) == dim]
    out = []
    for a, label, q in [r for r in rows if chosen(r[0])]:
        scored = sorted((-sum(x * y for x, y in zip(q, p, strict=True)), i, lab) for i, lab, p in rows)
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:k]:
            hits = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:m]
            out += [(a, p, n, x[1], -s, -x[0]) for n, x in enumerate(hits, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, 1, "c", 2, 3) for i, v, lab in rows], SCHEMA)


def plain(rows):
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in ok]


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("dim", [1, 2, 7, 16])
def test_equals_a_full_scan(spark, monkeypatch, dim):
    monkeypatch.setattr(negatives, "SHARD", 90)
    monkeypatch.setattr(negatives, "SCORE_ROWS", 8)
    rng = np.random.default_rng(dim)
    rows = [(i, rng.choice([-0.5, 0.25, 0.5, 1.0], dim).tolist() if i % 3 else rng.normal(size=dim).tolist(), int(rng.integers(3))) for i in range(300)]
    rows += [rows[10], rows[10], (10, rows[11][1], 1), (None, rows[1][1], 1), (600, None, 1), (650, [], 1), (700, rows[1][1], None), (750, [None] * dim, 1), (800, [math.nan] * dim, 1),
             (850, [math.inf] * dim, 2), (900, [1.0] * (dim + 1), 1), *[(1000 + i, rows[0][1], i % 2) for i in range(100)]]
    q = negatives.quantised(frame(spark, rows))
    assert sorted((r.vec_id, r.label, list(r.q)) for r in q.collect()) == sorted(plain(rows))
    assert found(negatives.hard_negatives(q, q.where("vec_id % 25 = 0"), words=4)) == brute(plain(rows), lambda i: i % 25 == 0)


def test_no_rows_no_anchors_and_large_components(spark):
    q = negatives.quantised(frame(spark, [(1, [0.5], 1), (2, [1.0], 1)]))
    assert found(negatives.hard_negatives(q.limit(0), q)) == found(negatives.hard_negatives(q, q.limit(0))) == found(negatives.hard_negatives(q, q)) == []
    big = [(1, [4e4, 3e4], 1), (2, [5e4, 1e4], 1), (3, [3e4, 1e4], 2), (4, [-1e4, 1e3], 2)]
    got = negatives.quantised(frame(spark, big))
    assert found(negatives.hard_negatives(got, got)) == brute(plain(big), lambda i: True) != []
    with pytest.raises(Exception, match="component"):
        negatives.hard_negatives(negatives.quantised(frame(spark, [(1, [1e9], 1), (2, [1.0], 1)])), q).collect()


def shard(rows, words):
    q = np.array([r[2] for r in rows], np.int64)
    h = -(-q.shape[1] // 2)
    books = negatives._fit(q[:, :h].astype(float), words), negatives._fit(q[:, h:].astype(float), words)
    cell = negatives._nearest(q[:, :h], books[0]) * len(books[1]) + negatives._nearest(q[:, h:], books[1])
    by = np.argsort(cell, kind="stable")
    cols = np.array([r[0] for r in rows])[by], np.array([r[1] for r in rows])[by], cell[by].astype("<i4"), q[by].astype("<i2")
    return negatives.Shard(dict(zip(("ids", "labels", "cells", "q"), (c.tobytes() for c in cols), strict=True)), books), q[by]


def test_cells_come_by_falling_bound_that_holds_and_search_stops_early():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 200
    rows = [(i, i % 3, np.round(centres[i % 12] + rng.normal(size=8) * 4).astype(int).tolist()) for i in range(2400)]
    s, q = shard(rows, 12)
    for a in q[:5]:
        seen = list(s.visits(a))
        assert sorted(lo for _, lo, _ in seen) == s.first.tolist() and [b for b, _, _ in seen] == sorted((b for b, _, _ in seen), reverse=True)
        assert all((q[lo:hi] @ a).max() <= b for b, lo, hi in seen)
        best, n = negatives.Best(5), [0]

        def take(scores, at, best=best, n=n):
            n[0] += len(at)
            best.offer(scores, s.ids[at])
        old, negatives.SCORE_ROWS = negatives.SCORE_ROWS, 64
        s.search(a, take, lambda best=best: best.floor)
        negatives.SCORE_ROWS = old
        want = sorted((-int(x), int(i)) for x, i in zip(q @ a, s.ids, strict=True))[:5]
        assert [(-int(x), int(i)) for x, i in zip(best.scores, best.ids, strict=True)] == want and n[0] < 800

"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Block, blocks, documents, id_array, land
from .tokenise import _KIND, cut
from .words import span_hash

#: Labelled examples in the index (expected, half of them toxic if there are enough; chosen by a hash of doc_id).
EXAMPLES = 8000
#: Terms enter the vocabulary if this many examples hold them, with this chi-square against the label.
LEAST_DF, CHI2 = 3, 12.0
#: Neighbours that vote, examples per index block, and blocks of examples that are scored before the others are bounded.
K, CELL, FIRST = 15, 64, 16
#: A term that one example in so many holds is common.
COMMON = 24


def terms(block: Block):
    """(document, hash) of every term: lower-cased runs without ASCII punctuation."""
    start, end, doc = cut(block)
    word = _KIND[block.data[start]] != 2
    return doc[word], span_hash(block.data, start[word], end[word], lower=True)


def _per_document(block: Block, vocab: np.ndarray | None):
    """(distinct terms, counts) of each document; with a vocabulary: term numbers."""
    doc, h = terms(block)
    if vocab is not None:
        at = np.searchsorted(vocab, h)
        ok = at < len(vocab)
        ok[ok] = vocab[at[ok]] == h[ok]
        doc, h = doc[ok], at[ok]
    cuts = np.searchsorted(doc, np.arange(block.n + 1))
    for i in range(block.n):
        yield np.unique(h[cuts[i]:cuts[i + 1]], return_counts=True)


def _gather(batches):
    for block in blocks(batches):
        got = list(_per_document(block, None))
        yield pa.RecordBatch.from_arrays([id_array(block), block.rows.column(block.rows.schema.get_field_index("toxic")),
                                          pa.array([t.tobytes() for t, _ in got], pa.binary()), pa.array([c.astype(np.int32).tobytes() for _, c in got], pa.binary())],
                                         ["doc_id", "toxic", "t", "c"])


def _frequencies(shared):
    def run(batches):
        vocab = shared.value
        df, n = np.zeros(len(vocab) + 1, np.int64), 0
        for block in blocks(batches):
            for t, _ in _per_document(block, vocab):
                df[t] += 1
            n += block.n
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "df": pa.array(df[at])})
    return run


class Index:
    """Inverted index whose postings are cut into blocks of ``CELL`` example numbers, each with its largest weight. Terms that one
    example in ``COMMON`` holds have a row of weights instead."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(vectors)
        self.cells = -(-self.n // CELL)
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)])
        example = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        df = np.bincount(term.astype(np.int64), minlength=n_terms)
        self.row = np.where(df * COMMON >= max(self.n, 1), np.cumsum(df * COMMON >= max(self.n, 1)) - 1, -1)
        self.rows = np.zeros((int(self.row.max(initial=-1)) + 1, self.cells * CELL))
        many = self.row[term.astype(np.int64)] >= 0
        self.rows[self.row[term[many].astype(np.int64)], example[many]] = weight[many]
        term, example, weight = term[~many], example[~many], weight[~many]
        order = np.lexsort((example, term))
        self.term, self.example, self.weight = term[order], example[order], weight[order]
        key = self.term * self.cells + self.example // CELL
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.block_from = np.concatenate([first, [len(key)]])
        self.block_cell = key[first] % max(self.cells, 1)
        self.block_max = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.term_from = np.searchsorted(self.term[first] if len(first) else first, np.arange(n_terms + 1))

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest positive cosine (ties: smallest number), exactly.

        A cell's upper bound is the sum of the query's weights times block maxima. The cells of the largest bounds are scored
        first; then, at once, all others whose bound reaches the k-th best so far. No other cell can hold one of the k."""
        if not len(t):
            return np.zeros(0, np.int64), np.zeros(0)
        row = self.row[t]
        base = w[row >= 0] @ self.rows[row[row >= 0]]
        t, w = t[row < 0], w[row < 0]
        lo, n = self.term_from[t], self.term_from[t + 1] - self.term_from[t]
        b = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        q, cell = np.repeat(w, n), self.block_cell[b]
        bound = base.reshape(-1, CELL).max(axis=1) + np.bincount(cell, q * self.block_max[b], self.cells)
        first = np.zeros(self.cells, bool)
        first[np.argsort(-bound, kind="stable")[:FIRST]] = True
        ids, scores = self._score(base, b, q, cell, first, skip)
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else 0.0
        more_ids, more = self._score(base, b, q, cell, ~first & (bound * (1 + 1e-12) >= least), skip)
        ids, scores = np.concatenate([ids, more_ids]), np.concatenate([scores, more])
        if len(ids) > k:  # all that tie with the k-th best stay until they are ordered
            top = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[top], scores[top]
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    def _score(self, base: np.ndarray, b: np.ndarray, q: np.ndarray, cell: np.ndarray, cells: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """Examples of positive cosine in the chosen cells, with their cosines: the common terms' part ``base``, and the others' postings."""
        use = cells[cell]
        b, q = b[use], q[use]
        m = self.block_from[b + 1] - self.block_from[b]
        p = np.repeat(self.block_from[b] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        s = np.where(np.repeat(cells, CELL), base, 0.0)
        if len(p):
            s += np.bincount(self.example[p], np.repeat(q, m) * self.weight[p], len(s))
        if skip >= 0:
            s[skip] = 0
        ids = np.flatnonzero(s > 0)
        return ids, s[ids]


def vector(t: np.ndarray, c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(c)) * idf[t]
    return w / np.sqrt(w @ w) if len(w) else w


def vote(cos: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Distance-weighted share of toxic neighbours (weight 1 / (distance + 0.1)), and the nearest toxic one's cosine."""
    w = 1 / (1.1 - np.minimum(cos, 1.0))
    return float((w * label).sum() / (w.sum() + 1.0)), float((cos * label).max(initial=0.0))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, ridge 1e-2."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-2 * b
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b))
        b = b - np.linalg.solve(hess, g)
    return b


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> dict | None:
    """Index, calibration and term weights from ``labels`` (doc_id, toxic 0/1, one row an id); None without examples."""
    spark = docs.sparkSession
    sizes = {int(r["toxic"]): r["count"] for r in labels.groupBy("toxic").count().collect()}
    if not sizes:
        return None
    rate = {y: min(1.0, examples / 2 / sizes[y]) for y in sizes}
    h = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 40))
    chosen = labels.where(F.when(F.col("toxic") == 1, h < int(rate.get(1, 0) * (1 << 40))).otherwise(h < int(rate.get(0, 0) * (1 << 40))))
    # about EXAMPLES rows of two numbers: a broadcast of bounded size; of rows that repeat a chosen id the least text is its example
    one = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    got = one.select("doc_id", "text", "toxic").mapInArrow(_gather, "doc_id long, toxic int, t binary, c binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["doc_id"], r["t"], r["c"]))
    t = [np.frombuffer(r["t"], np.uint64) for r in got]
    c = [np.frombuffer(r["c"], np.int32) for r in got]
    y = np.array([r["toxic"] for r in got], float)
    weight = np.array([1 / rate[int(v)] for v in y])
    uniq, back = np.unique(np.concatenate(t), return_inverse=True)
    of = np.repeat(y, [len(x) for x in t])
    pos, neg = np.bincount(back, of, len(uniq)), np.bincount(back, 1 - of, len(uniq))
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)
    a, b, cc, d = pos, neg, n1 - pos, n0 - neg
    chi2 = (n1 + n0) * (a * d - b * cc) ** 2 / np.maximum((a + b) * (cc + d) * n1 * n0, 1e-9)
    vocab = uniq[(a + b >= LEAST_DF) & (chi2 >= CHI2)]
    shared = spark.sparkContext.broadcast(vocab)
    freq = docs.select("doc_id", "text").mapInArrow(_frequencies(shared), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()  # a row per term
    df = np.zeros(len(vocab) + 1)
    for r in freq:
        df[r["term"]] = r["df"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    vectors = []
    for tt, ct in zip(t, c, strict=True):
        at = np.searchsorted(vocab, tt)
        ok = at < len(vocab)
        ok[ok] = vocab[at[ok]] == tt[ok]
        vectors.append((at[ok], vector(at[ok], ct[ok], idf)))
    # Examples that share their commonest terms are neighbours in the index: fewer blocks, tighter bounds.
    common = np.bincount(np.concatenate([a for a, _ in vectors]), minlength=len(vocab))
    by = sorted(range(len(vectors)), key=lambda i: (a := vectors[i][0])[np.argsort(-common[a], kind="stable")[:12]].tolist())
    got, y, weight, vectors = [got[i] for i in by], y[by], weight[by], [vectors[i] for i in by]
    index = Index(vectors, len(vocab))
    x = np.array([vote(cos, y[ids]) for ids, cos in (index.nearest(a, w, K, skip=i) for i, (a, w) in enumerate(vectors))])
    return {"vocab": vocab, "idf": idf, "index": index, "label": y, "ids": np.array([r["doc_id"] for r in got]), "b": calibrate(x, y, weight)}


def scores(m: dict, block: Block):
    """(score, nearest example ids, their cosines) of each document."""
    base = float(1 / (1 + np.exp(-m["b"][-1])))
    for t, c in _per_document(block, m["vocab"]):
        if not len(t):
            yield base, [], []
            continue
        ids, cos = m["index"].nearest(t, vector(t, c, m["idf"]), K)
        z = float(np.dot([*vote(cos, m["label"][ids]), 1.0], m["b"]))
        yield float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), m["ids"][ids[:3]].tolist(), cos[:3].tolist()


def _score(shared):
    def run(batches):
        for block in blocks(batches):
            score, near, cosine = (list(x) for x in zip(*scores(shared.value, block), strict=True))
            s = np.array(score)
            yield pa.RecordBatch.from_arrays([id_array(block), block.rows.column(block.rows.schema.get_field_index("held_out")), pa.array(s), pa.array((s >= 0.5).astype(np.int32)),
                                              pa.array(near, pa.list_(pa.int64())), pa.array(cosine, pa.list_(pa.float64()))], ["doc_id", "held_out", "score", "predicted", "evidence", "cosine"])
    return run


def _mild(shared):
    def run(batches):
        for block in blocks(batches):
            yield block.rows.filter(pa.array([s < 0.5 for s, _, _ in scores(shared.value, block)], pa.bool_()))
    return run


def _learnable(labels: DataFrame, mod: int, held: int) -> DataFrame:
    key = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod))
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
            .where(key != held).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def without_toxic(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, examples: int = EXAMPLES) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the documents that :func:`toxicity` predicts as 1; no join, no shuffle."""
    model = fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), _learnable(labels, mod, held), examples)
    return docs if model is None else docs.mapInArrow(_mild(docs.sparkSession.sparkContext.broadcast(model)), docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, examples: int = EXAMPLES) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, cosine): every document's calibrated probability of label 1,
    with the ids and cosines of its three nearest examples.

    Labels are learned only from ``labels`` (doc_id, toxic) whose crc32(doc_id as text) mod ``mod`` is not ``held``; rows that repeat an id
    count as toxic if any is. The index holds about ``examples`` of them. Term weights: (1 + log count) * idf, idf over all documents;
    the vocabulary keeps terms that the label depends on (chi-square among the examples).
    A document without such terms (empty and null texts too) has no neighbour and scores the calibrated base rate. Null ids are not held
    out. Repeated rows each come back. Without examples every score is 0. Extra columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    key = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learn = _learnable(labels, mod, held)
    model = fit(rows, learn, examples)
    rows = rows.withColumn("held_out", F.coalesce(key == held, F.lit(False)))
    if model is None:
        empty = F.array().cast("array<long>"), F.array().cast("array<double>")
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), empty[0].alias("evidence"), empty[1].alias("cosine"))
    shared = spark.sparkContext.broadcast(model)  # bounded by the examples
    return rows.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double, predicted int, evidence array<long>, cosine array<double>")


def op7_blockmax_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

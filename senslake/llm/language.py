"""Language identification: multinomial logistic regression on TF-IDF character n-grams, trained with FTRL-proximal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Block, blocks, documents, id_array, land, row_hash
from .words import HEAD, mix

#: Hashed buckets of character 2- and 3-grams.
BUCKETS = 1 << 15
#: Documents that the regression is fitted on, over all languages (expected; equal shares, by a hash of doc_id). Document frequencies and the set of
#: languages come from all documents that may be learned from.
SAMPLE = 3000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"


def gram_counts(block: Block):
    """Counts per bucket of each document, in turn; ASCII and Latin-1 case folded, ASCII non-letters taken as spaces."""
    chars = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    upper = (chars >= 65) & (chars <= 90) | (chars >= 0xC0) & (chars <= 0xDE) & (chars != 0xD7)
    chars = np.where(upper, chars + np.uint64(32), chars)
    chars[(chars < 128) & ~((chars >= 97) & (chars <= 122))] = 32
    offs = np.concatenate([[0], np.cumsum(HEAD[block.data])])[block.offs]
    top = np.uint64(64 - 15)
    two = (mix(chars[:-1] << np.uint64(21) | chars[1:]) >> top).astype(np.int64) if len(chars) > 1 else np.zeros(0, np.int64)
    three = (mix(chars[:-2] << np.uint64(42) | chars[1:-1] << np.uint64(21) | chars[2:] | np.uint64(1 << 63)) >> top).astype(np.int64) if len(chars) > 2 else np.zeros(0, np.int64)
    for i in range(block.n):
        a, b = offs[i], offs[i + 1]
        yield np.bincount(two[a:max(a, b - 1)], minlength=BUCKETS) + np.bincount(three[a:max(a, b - 2)], minlength=BUCKETS)


def has_letter(text: bytes) -> bool:
    s = text.decode("utf-8", "replace")
    return any(c.isalpha() for c in s[:64]) or any(c.isalpha() for c in s)


def _learn(batches):
    df, n = np.zeros(BUCKETS, np.int64), 0
    for block in blocks(batches):
        picked = block.rows.column(block.rows.schema.get_field_index("picked")).to_pylist()
        lang = block.rows.column(block.rows.schema.get_field_index("lang")).to_pylist()
        rows = [[], [], [], []]
        for i, c in enumerate(gram_counts(block)):
            df += c > 0
            n += 1
            if picked[i] is not None:
                at = np.flatnonzero(c)
                for r, x in zip(rows, (lang[i], picked[i], at.astype(np.int32).tobytes(), c[at].astype(np.int32).tobytes()), strict=True):
                    r.append(x)
        yield pa.RecordBatch.from_arrays([pa.array([1] * len(rows[0]), pa.int64()), *(pa.array(r, t) for r, t in zip(rows, (pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True))], ["n", "lang", "pick", "at", "c"])
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([None], pa.string()), pa.array([-1], pa.int64()), pa.array([b""], pa.binary()), pa.array([df.tobytes()], pa.binary())], ["n", "lang", "pick", "at", "c"])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Follow the regularised leader, per coordinate and class, with elastic-net penalties; returns (BUCKETS + 1, classes), the bias last."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at):
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, y in rows:
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None]
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
    return weights(np.arange(BUCKETS + 1))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its logarithm."""
    def nll(t):
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean()
    lo, hi, r = -0.7, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if nll(a) <= nll(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(train: DataFrame, sample: int = SAMPLE) -> dict | None:
    """``train`` (doc_id, text, lang), none null. Returns languages, idf, weights and temperature; None without rows."""
    spark = train.sparkSession
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return None
    langs = sorted(sizes)
    h, quota = F.pmod(row_hash(6), F.lit(1 << 40)), -(-sample // len(langs))
    share = F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(int(min(1.0, (1.3 * quota + 50) / sizes[g]) * (1 << 40))))])
    picked = train.select("text", "lang", F.when(h < share[F.col("lang")], h).alias("picked"))
    out = land(picked.mapInArrow(_learn, "n long, lang string, pick long, at binary, c binary"), "lang-sample")
    df, n = np.zeros(BUCKETS), 0
    for r in out.where("lang is null").toLocalIterator():  # a row per task
        df, n = df + np.frombuffer(r["c"], np.int64), n + r["n"]
    idf = np.log((1 + n) / (1 + df)) + 1
    # Repeats of a row count once, and each language has its quota at most.
    once = out.where("lang is not null").dropDuplicates(["pick", "lang"])
    got = once.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("pick"))).where(F.col("place") <= quota).collect()
    got.sort(key=lambda r: (r["pick"], r["lang"], r["at"], r["c"]))
    rows = []
    for r in got:
        at = np.frombuffer(r["at"], np.int32).astype(np.int64)
        x = np.frombuffer(r["c"], np.int32) * idf[at]
        x = x / max(np.sqrt(x @ x), 1e-12)
        rows.append((np.append(at, BUCKETS), np.append(x, 1.0), langs.index(r["lang"])))
    w = ftrl([r for i, r in enumerate(rows) if i % 5], len(langs))
    kept = [r for i, r in enumerate(rows) if i % 5 == 0]
    t = temperature(np.array([x @ w[at] for at, x, _ in kept]), np.array([y for _, _, y in kept])) if kept else 1.0
    return {"langs": langs, "idf": idf, "w": w, "t": t}


def _predict(shared):
    def run(batches):
        m = shared.value
        w, idf = m["w"] / m["t"], m["idf"]
        body, bias = w[:-1] * idf[:, None], w[-1]
        sq = idf * idf
        for block in blocks(batches):
            lang, score = [], []
            for i, c in enumerate(gram_counts(block)):
                if block.null[i] or not has_letter(block.text(i)):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                at = np.flatnonzero(c)
                x = c[at].astype(np.float64)
                p = softmax((x @ body[at]) / max(np.sqrt((x * x) @ sq[at]), 1e-12) + bias)
                best = int(p.argmax())
                lang.append(m["langs"][best])
                score.append(min(1.0, float(p[best])))
            yield pa.RecordBatch.from_arrays([id_array(block), block.rows.column(block.rows.schema.get_field_index("held_out")), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, mod: int = 4, held: int = 2, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for ``docs`` (doc_id, text, lang).

    Learns from text and lang of documents whose crc32(doc_id as text) mod ``mod`` is not ``held``; null ids, texts and
    langs teach nothing. A null ``doc_id`` is not held out. ``score`` is the calibrated probability of
    ``lang_pred``; null texts and texts without a letter give ``und`` and 0, and so does everything if there is nothing to learn from.
    Repeated rows each come back; ties between languages go to the first by name. Extra columns are ignored; an empty
    table gives an empty result."""
    spark = docs.sparkSession
    key = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang", F.coalesce(key == held, F.lit(False)).alias("held_out"))
    model = fit(rows.where("not held_out and doc_id is not null and text is not null and lang is not null").select("doc_id", "text", "lang"), sample)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    return rows.select("doc_id", "held_out", "text").mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def op6_ftrl_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return identify(documents(spark, sf_dir, "doc_id", "text", "lang"))

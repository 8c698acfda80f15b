"""Personal data: fixed base patterns, and boosted trees that choose among overlapping candidates."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Block, blocks, documents, id_array, id_text, sample_rows

#: Kinds in the order of the span list; the last is found by the trees alone.
KINDS = ("email", "ip", "card", "phone", "secret")
#: The trees are fitted on so many different documents at most, chosen by a hash, and so many candidates of each.
SAMPLE_DOCS, SAMPLE_EACH = 20_000, 40
TREES, DEPTH, BINS, RATE, RIDGE = 40, 3, 16, 0.3, 1.0
#: A split leaves this much weight (sum of p (1 - p)) on either side.
LEAST_WEIGHT = 3.0
#: Least calibrated probability of a span that the trees add.
PRECISION = 0.95
# Possessive runs keep every pattern linear in the text.
_LOCAL, _HOST = re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_TAIL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_IP_START = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")
# High-recall generators: (kind proposed, pattern).
_GENERATORS = (
    ("email", re.compile(r"(?<![^\s<>\"'(,;:])[A-Za-z0-9._%+-]++(?:@|[ ]?[\[(](?:at|AT)[\])][ ]?)[A-Za-z0-9-]++(?:(?:\.|[ ]?[\[(](?:dot|DOT)[\])][ ]?)[A-Za-z0-9-]++)*+")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}+")),
    ("card", re.compile(r"[0-9](?:[ .-]?[0-9]){11,}+")),
    ("phone", re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}+")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+")),
)
_CUE = {k: re.compile(p, re.I) for k, p in (
    ("email", r"mail|contact|write"), ("ip", r"\bip\b|host|server|address"), ("card", r"card|visa|pay|account"), ("phone", r"phone|tel|call|mobile|fax"),
    ("secret", r"(?:token|secret|key|passw\w*)[\"']?\s*[=:]\s*[\"']?$"))}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; each is found from its @, so a long run without one costs nothing."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and _LOCAL.match(text, start - 1):
            start -= 1
        m = _HOST.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            floor = m.end()
        else:
            floor = at + 1  # no match can begin before this @ any more
        at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """The base matches of email, ip, card, phone."""
    ip = [m.span() for m in _IP_START.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    card = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _NON_DIGIT.sub("", m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                card.append(m.span())
    phone = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_NON_DIGIT.sub("", m.group())) <= 15]
    return [emails(text), ip, card, phone]


def candidates(text: str, base: list[list[tuple[int, int]]]):
    """(kind number, start, end, features, label) of every proposed span. The label is weak: it overlaps a base span by four fifths, or, for
    secrets, follows an assignment to a word such as token; what decides the label is not among the features."""
    covered = sorted(s for spans in base for s in spans)
    starts = np.array([a for a, _ in covered])
    for number, (kind, pattern) in enumerate(_GENERATORS):
        for m in pattern.finditer(text):
            a, b = m.span()
            before, s = text[max(0, a - 24):a], m.group()
            if kind == "secret" and not (any(c.isdigit() for c in s) and any(c.isalpha() for c in s)):
                continue
            i = int(np.searchsorted(starts, b)) if covered else 0
            over = max((min(b, y) - max(a, x) for x, y in covered[max(0, i - 4):i]), default=0)
            label = bool(_CUE["secret"].search(before)) if kind == "secret" else 5 * over >= 4 * (b - a)
            yield number, a, b, features(number, s, before, text[b:b + 1]), label


def features(kind: int, s: str, before: str, after: str) -> list[float]:
    digits, alpha = sum(c.isdigit() for c in s), sum(c.isalpha() for c in s)
    groups = [len(g) for g in re.split(r"[^A-Za-z0-9]+", s) if g]
    n = len(s)
    counts = np.unique(np.frombuffer(s.encode("utf-8", "replace"), np.uint8), return_counts=True)[1] / max(n, 1)
    return [kind, n, digits, alpha, digits / n, sum(c.isupper() for c in s) / n, len(groups), max(groups, default=0), min(groups, default=0),
            s.count(" "), s.count("-"), s.count("."), s.count("("), float(-(counts * np.log2(counts)).sum()),
            float(all(c in "0123456789abcdef" for c in s)), float(before[-1:].isalnum()), float(after.isalnum()), float(before[-1:] in ("", " ", "\n")),
            *(float(bool(_CUE[k].search(before))) for k in KINDS[:4])]


class Boosted:
    """Gradient-boosted trees on binned features with logistic loss, and a logistic calibration of their sum."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        cal = np.arange(len(y)) % 4 == 0
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self._bin(x)
        fit, fy = binned[~cal], y[~cal]
        self.base = float(np.log((fy.sum() + 1) / (len(fy) - fy.sum() + 1)))
        f, self.trees = np.full(len(fy), self.base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree, leaf = self._grow(fit, p - fy, p * (1 - p))
            self.trees.append(tree)
            f += tree[2][leaf]
        raw, target = (self.raw(binned[cal]), y[cal]) if len(set(y[cal].tolist())) > 1 else (f, fy)
        # Platt's targets keep the calibration finite when the classes separate
        n1, n0 = target.sum(), (1 - target).sum()
        target = np.where(target > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, b = 1.0, 0.0
        for _ in range(40):
            q = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
            g = np.array([((q - target) * raw).sum(), (q - target).sum()])
            w = q * (1 - q)
            h = np.array([[(w * raw * raw).sum(), (w * raw).sum()], [(w * raw).sum(), w.sum()]]) + 1e-3 * np.eye(2)
            a, b = np.array([a, b]) - np.linalg.solve(h, g)
        self.a, self.b = float(a), float(b)

    def _bin(self, x):
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)], 1) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def _grow(self, x, g, h):
        feature, cut = np.full(2 ** DEPTH - 1, -1), np.zeros(2 ** DEPTH - 1, np.int64)
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-9)
            for j in range(x.shape[1]):
                key = (node - first) * (BINS + 1) + x[:, j]
                gs, hs = (np.bincount(key, v, width * (BINS + 1)).reshape(width, -1).cumsum(1) for v in (g, h))
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + RIDGE) + (total_g - gs) ** 2 / (total_h - hs + RIDGE) - total_g ** 2 / (total_h + RIDGE)
                gain[(hs < LEAST_WEIGHT) | (total_h - hs < LEAST_WEIGHT)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[first + k], cut[first + k] = top[k], j, at[k]
            f = feature[node]
            node = 2 * node + 1 + ((f >= 0) & (x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]))
        leaf = node - (2 ** DEPTH - 1)
        value = -RATE * np.bincount(leaf, g, 2 ** DEPTH) / (np.bincount(leaf, h, 2 ** DEPTH) + RIDGE)
        return (feature, cut, value), leaf

    def raw(self, binned):
        f = np.full(len(binned), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(binned), np.int64)
            for _ in range(DEPTH):
                j = feature[node]
                node = 2 * node + 1 + ((j >= 0) & (binned[np.arange(len(binned)), np.maximum(j, 0)] > cut[node]))
            f += value[node - (2 ** DEPTH - 1)]
        return f

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.raw(self._bin(x)) + self.b, -30, 30)))


def _texts(block: Block):
    """(index, text) of the documents that can hold a span: every pattern needs a digit, an @, or 'at' in brackets."""
    d = block.data
    hit = (d == 64) | (d >= 48) & (d <= 57)
    if len(d) >= 4:
        # [at], (AT) and mixed brackets, as the email generator takes them; one that spans two documents only costs a look
        a, t, z = d[1:-2], d[2:-1], d[3:]
        hit[:-3] |= ((d[:-3] == 91) | (d[:-3] == 40)) & ((a == 97) & (t == 116) | (a == 65) & (t == 84)) & ((z == 93) | (z == 41))
    mark = np.concatenate([[0], np.cumsum(hit)])
    for i in np.flatnonzero(mark[block.offs[1:]] > mark[block.offs[:-1]]).tolist():
        yield i, block.text(i).decode("utf-8", "replace")


def _training(batches):
    for block in blocks(batches):
        x, y = [], []
        for _, text in _texts(block):
            for k, (_, _, _, f, label) in enumerate(candidates(text, base_spans(text))):
                if k == SAMPLE_EACH:
                    break
                x.append(f)
                y.append(label)
        if x:
            yield pa.RecordBatch.from_pydict({"x": pa.array(x, pa.list_(pa.float64())), "y": pa.array(y, pa.bool_())})


def fit(rows: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Boosted | None:
    """Trees fitted on candidates of ``sample_docs`` different documents at most; None if they show one class only."""
    got = sample_rows(rows, sample_docs, 3).mapInArrow(_training, "x array<double>, y boolean").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float)
    if len(y) < 50 or not 0 < y.sum() < len(y):
        return None
    order = np.lexsort(np.column_stack([x, y]).T)
    # a fixed shuffle of the sorted rows: the same trees whatever order the rows arrived in
    order = order[np.random.Generator(np.random.PCG64(5)).permutation(len(order))]
    return Boosted(x[order], y[order])


def added(text: str, base: list[list[tuple[int, int]]], model: Boosted | None, least: float) -> list[tuple[int, int, int]]:
    """Candidates that reach ``least`` and overlap no base span; of overlapping ones the likelier, then the longer, then the first."""
    if model is None:
        return []
    got = list(candidates(text, base))
    if not got:
        return []
    p = model.probability(np.array([f for *_, f, _ in got]))
    taken = sorted(s for spans in base for s in spans)
    out = []
    for i in sorted(np.flatnonzero(p >= least).tolist(), key=lambda i: (-p[i], got[i][1] - got[i][2], got[i][1], got[i][0])):
        kind, a, b = got[i][:3]
        at = int(np.searchsorted([x for x, _ in taken], b)) if len(taken) < 64 else _bisect(taken, b)
        if not any(y > a for _, y in taken[max(0, at - 2):at]):
            taken.insert(at, (a, b))
            out.append((kind, a, b))
    return out


def _bisect(spans, b):
    import bisect
    return bisect.bisect_left(spans, (b, b))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind; overlapping spans are replaced as one, under the first's kind."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


_EMPTY = hashlib.sha256(b"").hexdigest()


def _find(shared, least: float):
    def run(batches):
        model = shared.value
        for block in blocks(batches):
            counts, sha, listed = np.zeros((4, block.n), np.int64), [_EMPTY] * block.n, [""] * block.n
            text = [None if null else t for null, t in zip(block.null.tolist(), block.rows.column(block.rows.schema.get_field_index("text")).to_pylist(), strict=True)]
            for i, t in _texts(block):
                base = base_spans(t)
                spans = [(k, a, b) for k, found in enumerate(base) for a, b in found]
                counts[:, i] = [len(found) for found in base]
                sha[i] = hashlib.sha256(_listed(spans).encode()).hexdigest()
                spans += added(t, base, model, least)
                listed[i] = _listed(spans)
                if spans:
                    text[i] = redact(t, spans)
            yield pa.RecordBatch.from_arrays([id_array(block), *(pa.array(c) for c in counts), pa.array(sha), pa.array(listed), pa.array(text, pa.string())],
                                             ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted"])
    return run


def find_pii(docs: DataFrame, least: float = PRECISION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted) for every document.

    Counts and digest are of the base patterns; ``spans`` adds the candidates that boosted trees accept with a calibrated probability of
    ``least``; offsets are code points, ends exclusive. The trees see format (lengths, groups, separators, entropy) and context
    (neighbours, cue words before), and learn from weak labels on a bounded, hash-chosen sample of documents; with fewer than 50
    candidates, or one class, nothing is added. Null text: no spans, ``redacted`` null. Repeated rows each come back; null ids stay.
    Extra columns are ignored; an empty table gives an empty result. All patterns are linear in the text."""
    rows = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows))
    return rows.mapInArrow(_find(shared, least), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string")


def _redact(shared, least: float):
    def run(batches):
        for block in blocks(batches):
            names = block.rows.schema.names
            text = block.rows.column(names.index("text")).to_pylist()
            for i, t in _texts(block):
                base = base_spans(t)
                spans = [(k, a, b) for k, found in enumerate(base) for a, b in found]
                text[i] = redact(t, spans + added(t, base, shared.value, least))
            cols = list(block.rows.columns)
            cols[names.index("text")] = pa.array(text, pa.string())
            if "n_chars" in names:
                cols[names.index("n_chars")] = pa.array([None if t is None else len(t) for t in text], block.rows.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def redacted(docs: DataFrame, least: float = PRECISION) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with every span that :func:`find_pii` lists replaced by its kind in brackets; ``n_chars``,
    if there, counts the new text. No join, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(id_text(docs)))
    return docs.mapInArrow(_redact(shared, least), docs.schema)


def op3_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_pii(documents(spark, sf_dir)).drop("redacted")

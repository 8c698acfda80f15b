"""The prefix trie against a plain dictionary of prefixes."""

import collections
import hashlib
import zlib

import numpy as np
import pytest

from senslake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, length long"


def rebuilt(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - int(np.fmod(c, 100))
        out[c] = own.get(head, [])[:h] + t[h:]
    return out


def nodes(paths):
    members = collections.defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    saved, leaves = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    return {(min(m), len(p)): (min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                               hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()}


def got(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(out) == len(rows) and df.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 7) for r in rows], SCHEMA)
    return got(trie.prefix_trie(*trie.forked(*trie.numbered_turns(df))))


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(4)
    rows = [(None, 1, "user", "of no conversation"), (7, None, None, None), (7, 1, "user", ""), (8, 1, "user", ""), (8, None, "", None), (-5, 2, "user", "minus"), (-100, 0, "user", "head of minus five"),
            (300, 3, "user", "é" * 5000), (305, 0, "user", "short"), (900, 0, "a", "x"), (9, 1, "b", "tie"), (9, 1, "a", "tie"), (9, 1, "a", "tie")]
    rows += [(c, t, ("user", "assistant")[t % 2], f"turn {t} {rng.integers(2)}") for c in range(100, 180) for t in range(int(rng.integers(9)))]
    rows += [(c, t, "user", f"long {t}") for c in (400, 401, 402) for t in range(30)] + [(402, 30, "user", "one more")]
    return rows


def test_trie_equals_the_dictionary(spark, odd):
    assert run(spark, odd) == nodes(rebuilt(odd))


def test_blocks_and_chunks_change_nothing(spark, odd, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    assert run(spark, odd) == nodes(rebuilt(odd))


def test_a_full_sketch_lets_more_through_with_the_same_result(spark, odd, monkeypatch):
    def all_may_be_shared(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([2] * b.num_rows, pa.int32())], names=[*b.schema.names, "kind"])
    monkeypatch.setattr(trie, "_screen", lambda shared, width: all_may_be_shared)
    assert run(spark, odd) == nodes(rebuilt(odd))


def test_false_hits_below_a_singleton_are_tails(spark, odd, monkeypatch):
    real = trie._screen

    def noisy(shared, width):
        f = real(shared, width)

        def run_(batches):
            import pyarrow as pa
            for b in f(batches):
                hit = (b.column(3).to_numpy() & 3) == 0
                up = (b.column(5).to_numpy() & 3) == 0
                kind, depth = b.column(8).to_numpy(), b.column(1).to_numpy()
                kind = np.where(hit | (kind == 2), 2, np.where(up | (depth == 1), 1, kind))
                yield b.set_column(8, "kind", pa.array(kind, pa.int32()))
        return run_
    monkeypatch.setattr(trie, "_screen", noisy)
    assert run(spark, odd) == nodes(rebuilt(odd))


def test_one_first_turn_in_all_conversations(spark):
    rows = [(c, t, "user", "hello" if not t else f"{c} {t}") for c in range(1, 2000) for t in range(2)]
    turns, convs = trie.numbered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = got(trie.prefix_trie(turns, convs))
    assert out == nodes({c: [("user", "hello"), ("user", f"{c} 1")] for c in range(1, 2000)})
    assert out[(1, 1)][:4] == (1, 1999, 1999, 1999)


def test_joined_ids_hash_as_one_text(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(trie, "IDS_CHARS", 8)
    ends = [(1, 1, c) for c in range(95, 130)] + [(1, 2, 7), (2, 0, -3)]
    runs = list(trie._join_ids([pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*ends[i:i + 9], strict=True)], names=["p1", "p2", "conv_id"]) for i in range(0, len(ends), 9)]))
    assert max(len(r.column(3)[0].as_py()) for r in runs) <= 11
    got = [tuple(x.as_py() for x in (b.column(0)[0], b.column(1)[0], b.column(2)[0])) for b in trie._sha(runs)]
    assert got == [(*k, hashlib.sha256(",".join(str(c) for *p, c in ends if tuple(p) == k).encode()).hexdigest()) for k in ((1, 1), (1, 2), (2, 0))]


def test_no_conversations(spark):
    assert run(spark, [(None, 1, "a", "b")]) == {}


def test_estimates_never_fall_below_the_counts(spark):
    p = np.random.default_rng(1).integers(-2**63, 2**63 - 1, (3000, 2))
    df = spark.createDataFrame([tuple(map(int, x)) for x in np.concatenate([p, p[:500]])], "p1 long, p2 long")
    bits, width = trie.count_min(df)
    cells = trie._cells(np.ascontiguousarray(p[:, 0]), np.ascontiguousarray(p[:, 1]), width)
    more = ((bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=0)
    assert more[:500].all() and more[500:].mean() < 0.01

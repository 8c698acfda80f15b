"""Arrow tasks give their freed memory back batch by batch."""

import pyarrow as pa

from senslake.llm import common


def test_blocks_release_after_each_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(["ab"] * n, pa.string())}) for n in (5, 0, 7)]
    assert [b.n for b in common.blocks(iter(batches), limit=6)] == [3, 2, 3, 3, 1]
    assert len(calls) == 3


def test_release_runs():
    common.release()

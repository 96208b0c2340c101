"""Shared helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.llm import bitfilter, common


def test_sums_in_levels(spark):
    def rows(batches):
        for b in batches:
            for i in b.column("id").to_pylist():
                yield pa.RecordBatch.from_pydict({"a": [np.full(32, i, np.uint32).tobytes()], "b": [np.arange(16, dtype=np.float32).tobytes()]})

    df = spark.range(0, 100, 1, 23).mapInArrow(rows, "a binary, b binary")
    before, common.FAN_IN = common.FAN_IN, 3
    a, b = common.array_sums(df, [np.uint32, np.float32], lambda x: [x[0].astype(np.int64), x[1]])
    common.FAN_IN = before
    assert a.tolist() == [4950] * 32 and b.tolist() == [100.0 * i for i in range(16)]
    assert common.array_sums(df.limit(0), [np.uint32, np.float32]) == []


def test_filter_passes_all_it_holds(spark):
    held = spark.range(1000).selectExpr("xxhash64(id) as h")
    words = bitfilter.build(held)
    h = np.array([r["h"] for r in held.collect()], np.int64).view(np.uint64)
    assert bitfilter.passing(words, h).all()
    others = np.random.default_rng(1).integers(0, 2**64, 10_000, dtype=np.uint64)
    assert bitfilter.passing(words, others).mean() < 0.05
    assert not bitfilter.passing(bitfilter.build(held.limit(0)), others).any()


def test_slices_keep_all_rows_and_bound_bytes():
    texts = ["x" * n for n in (5, 50, 1, 0, 3, 200, 2)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": texts, "i": list(range(8))})
    cut = list(common.slices([batch, batch.slice(0, 0)], "text", 20))
    assert [i for b in cut for i in b.column("i").to_pylist()] == list(range(8))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column("text").to_pylist()) <= 20 for b in cut)


def test_a_worker_gives_back_its_memory_after_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "trimmed", lambda: calls.append(1), raising=False)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 20])], names=["text"])
    assert sum(x.num_rows for x in common.slices(iter([batch]), "text", 12)) == 3
    assert calls == [1]
    assert sum(x.num_rows for x in common.slices(iter([batch]), "text", 12, keep=True)) == 3  # an operator that keeps something goes on with it
    assert calls == [1]

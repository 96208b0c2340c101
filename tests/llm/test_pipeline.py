"""The pipeline's stages one after another against brute force on a small table; queries are registered and guarded."""

from __future__ import annotations

import re

import pytest

import __spark_entry__
import corpus_pipeline

from . import data
from .test_documents import aligned, components, contaminated, key, near_copies, reference_ids, repeated


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    docs, items = contaminated()
    rows = data.rows() + near_copies() + [(5000 + i, t, "en", "s", len(t or ""), *[None] * 8) for i, (_, t) in enumerate(docs)]
    rows = [(r[0], r[1], "en", r[3], r[4]) for r in rows]  # one language, so that all of its n-grams are known
    rows.append((5, "zqxj vkwz qqxz jjvw zxkq wvvz qjxk zzkq xwqv jkzz qxvw kjqz xvzq wqkj", "en", "s", 67))  # n-grams that no other text has; 5 is not learned from
    rows.append((None, "Re.", "en", "s", 3))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([x for x in items if x[0] is not None], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, [x for x in items if x[0] is not None]


def test_stages(spark, tables, tmp_path):
    folder, rows, items = tables
    docs, outs = spark.read.parquet(f"{folder}/documents.parquet"), []
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        outs.append([tuple(r) for r in docs.collect()])
        assert i == 4 or docs.columns == names
    told, single, stripped, clean, encoded = outs
    letters = lambda t: bool(re.search(r"[^\W\d_]", t or ""))
    assert {key(r[0]) for r in told} <= {key(r[0]) for r in rows if letters(r[1])}
    assert not any((r[1] or "").startswith("zqxj") for r in told) and any(r[1] == "Re." for r in told)
    assert len(told) >= 0.9 * sum(letters(r[1]) for r in rows)  # held-out rows of rare n-grams go
    sets, top = components(told, 5, 80, 100)
    kept = {}
    for r, s, t in zip(told, sets, top, strict=True):
        kept.setdefault(t if s else id(r), []).append(r[0])
    last = lambda d: (d is None, d or 0)
    assert sorted((r[0] for r in single), key=last) == sorted((min(x, key=last) for x in kept.values()), key=last)
    left = {}
    for (d, w, gone), r in zip(repeated(single, 35), single, strict=True):
        left[d, r[1]] = " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else r[1]
    assert sorted(left.values()) == sorted(r[1] for r in stripped)
    assert all(r[4] == len(r[1]) for r in stripped)
    bad = aligned([(i, r[1]) for i, r in enumerate(stripped)], items)
    assert sorted((key(r[0]), r[1]) for r in clean) == sorted((key(r[0]), r[1]) for i, r in enumerate(stripped) if not any(d == i for d, _ in bad))
    assert len(clean) < len(stripped)
    assert sorted((key(r[0]), r[3], r[7]) for r in encoded) == sorted((key(r[0]), len(reference_ids(r[1])), reference_ids(r[1])) for r in clean)
    assert all(r[6] for r in encoded)
    assert corpus_pipeline.run(spark, folder).count() == len(encoded)


def test_empty_tables(spark, tables, tmp_path):
    folder = tables[0]
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)

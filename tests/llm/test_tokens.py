"""Token files and BPE against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe, chunks, simple8b, textkernel, token_files

from . import data

P = pytest.importorskip("public_tokenizers")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@cache
def encoders():
    return token_files.LibraryEncoder(P.path("byte_bpe_50k.json")), bpe.DuckBpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def reference():
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(path), special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60000) | st.integers(0, 1), max_size=3000))
def test_simple8b_round_trip(ids):
    given_ids = np.array(ids, np.uint64)
    packed, sizes = simple8b.encode(given_ids)
    assert (simple8b.decode(packed, sizes, len(ids)) == given_ids).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab' \n\t.,1é×ü日  　\x1c\x85s"), max_size=30) | st.none(), max_size=6))
def test_texts_are_encoded_as_the_libraries_do(texts):
    (files, own), model = encoders(), library()
    ids, first = files.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == model.encode(t or "", add_special_tokens=False).ids
    ids, first = own.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == reference().encode_ordinary(t or "")
    back, edge = own.decode_documents(ids, first)
    assert [back[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)] == [(t or "").encode() for t in texts]
    assert own.decode(ids, first) == [(t or "").encode() for t in texts]


def test_cache_finds_what_it_was_given_and_keeps_what_was_found_again():
    cache = chunks.Cache(400)
    for k in range(40):
        keys = np.arange(k * 10, k * 10 + 10, dtype=np.uint64)
        cache.make_room(10)
        assert (cache.find(keys, keys) < 0).all()
        cache.add(keys, keys, np.full(10, 2, np.int32), np.repeat(keys, 2).astype(np.int32))
    asked = np.array([395, 3], np.uint64)
    assert cache.ids(cache.find(asked, asked))[1].tolist() == [395, 395, 3, 3]
    assert cache.find(np.array([400, 395], np.uint64), np.array([400, 1], np.uint64)).tolist() == [-1, -1]  # the second has another check
    cache.make_room(1)
    assert cache.entries == 2 and cache.ids(cache.find(asked, asked))[1].tolist() == [395, 395, 3, 3]
    assert cache.find(np.array([4], np.uint64), np.array([4], np.uint64)).tolist() == [-1]


def test_token_files(spark, tmp_path):
    docs = data.frame(spark)
    manifest = token_files.write(docs, f"file://{tmp_path}", P.path("byte_bpe_50k.json"), 0)
    got = [tuple(r) for r in token_files.read_digests(manifest).collect()]
    model = library()
    ordered = sorted(data.rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for r in ordered:
        ids = [*model.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_files.write_and_read(spark, docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_full_shards_are_followed_by_others(spark, tmp_path, monkeypatch):
    docs = data.frame(spark)
    whole = token_files.write_and_read(spark, docs, P.path("byte_bpe_50k.json")).collect()
    monkeypatch.setattr(token_files, "SHARD_DOCS", 1)
    monkeypatch.setattr(token_files, "slices", lambda batches, *a, **b: (x.slice(i, 1) for x in batches for i in range(x.num_rows)))
    manifest = token_files.write(docs, f"file://{tmp_path}", P.path("byte_bpe_50k.json"), 0)
    assert manifest.count() == docs.count()
    assert sorted(map(str, token_files.read_digests(manifest).collect())) == sorted(map(str, whole))


def test_bpe_queries(spark):
    docs, enc = data.frame(spark), reference()
    path = P.path("byte_bpe_multi_50k.tiktoken")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, path, P.PATTERN, ["doc_id"]).collect())
    want = []
    for r in data.rows():
        ids = enc.encode_ordinary(r[1] or "")
        want.append((r[0] if r[0] is not None else -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert got == sorted(want)
    encoded = bpe.encode(docs, path, P.PATTERN)
    assert encoded.columns[-1] == "ids" and encoded.columns.count("ids") == 1
    back = bpe.decode(encoded, path, P.PATTERN).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)
    assert bpe.digests(docs.limit(0), path, P.PATTERN, ["doc_id"]).count() == 0


def test_bpe_of_long_matches_and_documents_without_spaces():
    rng, enc = random.Random(5), reference()
    own = bpe.DuckBpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    word = lambda n, letters="ACGTacgt日本語é": "".join(rng.choice(letters) for _ in range(n))
    texts = [word(50_000, "acgt"), word(20_000), *[word(900) for _ in range(60)], *[word(200, "etaoinsr") for _ in range(300)], *[word(n, "etaoins") for n in range(100, 140) for _ in range(40)], "ab" * 3000]
    ids, first = own.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == enc.encode_ordinary(t)
    back, edge = own.decode_documents(ids, first)
    assert [back[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)] == [t.encode() for t in texts]


def test_bpe_decodes_millions_of_ids_without_spaces():
    own = bpe.DuckBpe(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    letters = np.frombuffer(b"acgtxyz", np.uint8)[np.arange(2_500_000) * 7919 % 7]
    ids, first = own.byte_id[letters], np.array([0, 3, 2_000_003, 2_000_003, 2_500_000])
    want = [letters[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]
    assert own.decode(ids, first) == want
    back, edge = own.decode_documents(ids, first)
    assert [back[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)] == want
    wide = np.repeat(np.int32(max(own.ranks.items(), key=lambda x: len(x[0]))[1]), 300_000)  # the longest token
    assert own.decode(wide, np.array([0, len(wide)])) == [max(own.ranks, key=len) * len(wide)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aA \n\x0bé\x1f", max_size=20) | st.none(), max_size=6), st.booleans())
def test_words_and_windows(texts, lower):
    w = textkernel.words(pa.array(texts, pa.string()), lower)
    want = [data.words(data.lowered(t) if lower else t) for t in texts]
    assert [[bytes(w.data[a:b]).decode() for a, b in zip(w.start[x:y], w.end[x:y], strict=True)] for x, y in zip(w.first, w.first[1:], strict=False)] == want
    h, flat = w.hashes(), [x for t in want for x in t]
    assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))
    runs = textkernel.window_hashes(h, 3)
    assert len({(tuple(flat[i : i + 3]), x) for i, x in enumerate(runs.tolist())}) == len(set(runs.tolist()))
    least = textkernel.sliding_argmin(h, 4)
    assert least.tolist() == [i + int(np.argmin(h[i : i + 4])) for i in range(len(h) - 3)]

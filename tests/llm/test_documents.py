"""Near-duplicates, repeated windows, benchmark items, languages and scores against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import bands, bpe, decontaminate, jaccard, langid, maxent, minhash, substring, textkernel
from tessera.llm.common import held_out

from . import data

key = lambda x: -1 if x is None else x


def reference_ids(text):
    import tiktoken

    P = pytest.importorskip("public_tokenizers")
    if not hasattr(reference_ids, "model"):
        reference_ids.model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    return reference_ids.model.encode_ordinary(text or "")


def shingles(text, width):
    w = data.words(data.lowered(text))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def components(rows, width, num, den):
    sets = [shingles(r[1], width) for r in rows]
    above = list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                above[top(i)] = top(j)
    return sets, [top(i) for i in range(len(rows))]


def near_copies():
    """A base with copies of few edits, a chain whose ends don't link, and unlinked texts with the same passage."""
    base = data.words(data.rows()[9][1])[:200]
    out = []
    for i in range(30):
        w = list(base)
        for j in range(i % 4):
            w[(17 * i + 31 * j) % len(w)] = f"edit{i}x{j}"
        out.append(" ".join(w))
    chain = [f"c{i}" for i in range(130)]
    out += [" ".join(chain[2 * k : 2 * k + 100]) for k in range(10)]
    out += [" ".join([f"own{i}x{j}" for j in range(30)] + base[:25]) for i in range(12)]
    return [(1000 + i, t, *[None] * 11) for i, t in enumerate(out)]


def test_jaccard_join(spark):
    rows = data.rows() + near_copies()
    sets, top = components(rows, 3, 90, 100)
    members = collections.defaultdict(list)
    for r, s, t in zip(rows, sets, top, strict=True):
        if s:
            members[t].append(r[0])
    least = lambda t: min((x for x in members[t] if x is not None), default=None)
    want = sorted((key(r[0]), len(s), key(least(t) if s else r[0])) for r, s, t in zip(rows, sets, top, strict=True))
    got = sorted((key(r["doc_id"]), r["n_shingles"], key(r["component_id"])) for r in jaccard.digests(data.frame(spark, rows)).collect())
    assert got == want
    assert jaccard.digests(data.frame(spark, []).limit(0)).count() == 0


def test_bands_find_near_duplicates(spark):
    rows = data.rows() + near_copies()
    sets, top = components(rows, 5, 80, 100)
    least = {t: min((r[0] for r, x in zip(rows, top, strict=True) if x == t and r[0] is not None), default=None) for t in top}
    want = sorted((key(r[0]), len(s), key(least[t] if s else r[0])) for r, s, t in zip(rows, sets, top, strict=True))
    assert sorted((key(r["doc_id"]), r["n_shingles"], key(r["class_id"])) for r in bands.near_duplicates(data.frame(spark, rows)).collect()) == want
    assert bands.near_duplicates(data.frame(spark, [])).count() == 0


def test_bands_compare_few_pairs_of_a_group_of_unlinked_texts(spark, monkeypatch):
    rng = random.Random(11)
    base, texts = [f"w{k}" for k in range(150)], []
    for i in range(160):  # half of them link with the first text; the others share bands with it and with each other, but link with none
        w = list(base)
        for at in rng.sample(range(30), 2 if i % 2 else 5):
            w[5 * at + 2] = f"x{i}y{at}"
        texts.append(" ".join(w))
    rows = [(i, t, *[None] * 11) for i, t in enumerate([" ".join(base), *texts])]
    asked, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda docs, signed, pairs, *a: asked.append(pairs.count()) or verified(docs, signed, pairs, *a))
    got = {r["doc_id"]: r["class_id"] for r in bands.near_duplicates(data.frame(spark, rows)).collect()}
    sets, top = components(rows, 5, 80, 100)
    least = {t: min(r[0] for r, x in zip(rows, top, strict=True) if x == t) for t in top}
    assert got == {r[0]: least[t] for r, t in zip(rows, top, strict=True)}
    assert len(set(got.values())) > 70
    assert sum(asked) < 32 * len(rows), asked  # a list for each band; all pairs of lists are several times as many


def test_one_of_each_near_duplicate_stays(spark):
    rows = data.rows() + near_copies()
    sets, top = components(rows, 5, 80, 100)
    want = len({t for s, t in zip(sets, top, strict=True) if s}) + sum(not s for s in sets)
    kept = jaccard.one_of_each(data.frame(spark, rows), 5, 80, 100)
    assert kept.columns == data.frame(spark).columns
    assert kept.count() == want
    best = {t: min((x[0] for x, y in zip(rows, top, strict=True) if y == t and x[0] is not None), default=None) for t in top}
    assert sorted(key(best[t]) for t in {t for s, t in zip(sets, top, strict=True) if s}) == sorted(key(r["doc_id"]) for r in kept.where("trim(coalesce(text, '')) <> '' and text <> '\t\n'").collect())


def repeated(rows, window):
    seen = collections.Counter(tuple(w[i : i + window]) for r in rows for w in [data.words(r[1])] for i in range(len(w) - window + 1))
    out = []
    for r in rows:
        w = data.words(r[1])
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = b"\1" * window
        out.append((r[0], w, gone))
    return out


def test_substring_dedup(spark, tmp_path):
    rows = data.rows() + near_copies()
    for window, batches in ((35, 2), (5, 7)):  # seven batches are compacted on the way
        want = sorted((key(d), len(w), sum(g), hashlib.sha256(" ".join(x for x, y in zip(w, g, strict=True) if not y).encode()).hexdigest()) for d, w, g in repeated(rows, window))
        got = sorted((key(r[0]), *r[1:]) for r in map(tuple, substring.digests(data.frame(spark, rows), window, batches, f"file://{tmp_path}/w{window}").collect()))
        assert got == want
    left = substring.strip(data.frame(spark, rows)).select("doc_id", "text").collect()
    plain = {(key(d), tuple(w)): " ".join(x for x, y in zip(w, g, strict=True) if not y) for d, w, g in repeated(rows, 35) if any(g)}
    assert sorted(r["text"] for r in left if r["text"] in plain.values() and r["text"]) == sorted(x for (d, _), x in plain.items() for _ in range(sum(key(r[0]) == d and data.words(r[1]) == list(_k) for r in rows for _k in [_])) if x)
    assert substring.digests(data.frame(spark, [])).count() == 0


def test_a_new_batch_is_joined_with_the_runs_of_an_index_opened_again(spark, tmp_path):
    rows = data.rows() + near_copies()
    every = data.frame(spark, rows).select("doc_id", "text")
    tally = lambda df: {r["h"]: (r["n"], r["lo"], r["hi"]) for r in substring.entries(df, 12).groupBy("h").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    hits, history = {}, every.limit(0)
    for k in range(6):  # compacted on the way
        index = substring.FingerprintIndex(spark, f"file://{tmp_path}/index")
        batch = every.where(f"pmod(coalesce(doc_id, 0), 6) = {k}")
        found = {r["h"]: r["mixed"] for r in index.add(substring.entries(batch, 12)).collect()}
        old, new = tally(history), tally(batch)
        assert found == {h: min(lo, old.get(h, (0, lo))[1]) != max(hi, old.get(h, (0, 0, hi))[2]) for h, (n, lo, hi) in new.items() if n > 1 or h in old}
        hits, history = hits | found, history.unionByName(batch)
    assert 1 < len(index.runs) <= substring.MOST_RUNS + 1
    assert hits == {h: lo != hi for h, (n, lo, hi) in tally(every).items() if n > 1} and set(hits.values()) == {True, False}
    index.delete()


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def aligned(docs, items):
    """Every item laid over every document at every offset."""
    out = {}
    for d, t in docs:
        w = tokens(t)
        for i, it in items:
            x = tokens(it)
            wide = min(13, len(x))
            for o in range(-len(x), len(w)) if x else ():
                low, high = max(0, -o), min(len(x), len(w) - o)
                same = [w[o + j] == x[j] for j in range(low, high)]
                best = max((sum(same[k : k + wide]) for k in range(len(same) - wide + 1)), default=0)
                if best * 5 >= wide * 4:
                    out[d, i] = max(best, out.get((d, i), 0))
    return out


def contaminated():
    item = "the quick brown fox jumps over a lazy dog while seven wizards box very jovially near old quartz mines at dawn".split()
    changed = list(item)
    changed[3] = changed[9] = changed[15] = "other"
    docs = [(1, "Intro: " + " ".join(item) + "."), (2, "x y z " + " ".join(changed) + " tail"), (3, " ".join(item[:9])), (4, "nothing of that kind here"), (5, " ".join(item[4:19]).upper()), (6, None), (7, ""), (None, " ".join(item))]
    return docs, [(10, " ".join(item)), (11, "one two three"), (12, None), (13, " ".join(item)), (None, " ".join(item))]


def test_decontamination(spark):
    docs, items = contaminated()
    rows = [(d, t, *[None] * 11) for d, t in docs] + [(100 + r[0], *r[1:]) for r in data.rows()[:20]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = aligned([(key(r[0]), r[1]) for r in rows], [x for x in items if x[0] is not None])
    assert {(1, 10), (2, 10), (5, 10), (-1, 13)} <= set(want)
    for most in (decontaminate.MOST_SEEDS, 0):
        got = {(key(r["doc_id"]), r["item_id"]): r["n_agreeing"] for r in decontaminate.found(data.frame(spark, rows), bench, ["doc_id"], most_seeds=most).collect()}
        assert got == want
    kept = decontaminate.clean(data.frame(spark, rows), bench)
    assert kept.columns == data.frame(spark).columns
    assert sorted(key(r["doc_id"]) for r in kept.collect()) == sorted(key(r[0]) for r in rows if not any(d == key(r[0]) for d, _ in want))
    assert decontaminate.found(data.frame(spark, rows), bench.limit(0), ["doc_id"]).count() == 0
    assert decontaminate.found(data.frame(spark, []), bench, ["doc_id"]).count() == 0


def test_decontamination_of_short_items_and_unspaced_scripts(spark):
    unspaced = "[\u0e00-\u0eff\u3040-\u30ff\u4e00-\u9fff]"
    items = [(1, "alpha"), (2, "beta gamma"), (3, "one two three"), (4, "w1 w2 w3 w4"), (5, "a1 a2 a3 a4 a5"), (6, "b1 b2 b3 b4 b5 b6"), (7, "c1 c2 c3 c4 c5 c6 c7"), (8, "東京は日本の首都です"), (9, "สวัสดีครับ"), (10, "首都"), (11, "!?"), (12, None)]
    texts = ["x alpha y", "beta gamma", "beta x gamma", "so one two three.", "w1 w2 w3", "w1 w2 W3 w4 z", "これは東京は日本の首都です。", "abc東京は日本の都都ですabc", "พูดสวัสดีครับนะ", "日本", None, ""]
    for _, t in items[4:7]:
        w = t.split()
        for changes in [(), *[(p,) for p in range(len(w))], (0, 1), (1, len(w) - 1)]:
            texts.append("q r " + " ".join("zz" if i in changes else x for i, x in enumerate(w)) + " s")
    cut = lambda t: re.findall(f"{unspaced}|(?:(?!{unspaced})[^\\W_])+", (t or "").lower())
    want = set()
    for d, t in enumerate(texts):
        w = cut(t)
        for i, it in items:
            x = cut(it)
            if x and any(5 * sum(a == b for a, b in zip(w[o : o + len(x)], x, strict=True)) >= 4 * len(x) for o in range(len(w) - len(x) + 1)):
                want.add((d, i))
    assert {(0, 1), (1, 2), (3, 3), (5, 4), (6, 8), (7, 8), (8, 9), (6, 10)} <= want and not {(2, 2), (4, 4)} & want
    docs, bench = data.frame(spark, [(d, t, *[None] * 11) for d, t in enumerate(texts)]), spark.createDataFrame(items, "item_id long, text string")
    for most in (decontaminate.MOST_SEEDS, 0):
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.found(docs, bench, ["doc_id"], most_seeds=most).collect()} == want
    kept = {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in want}


def test_decontamination_runs_no_python(spark):
    docs, items = contaminated()
    df = decontaminate.found(data.frame(spark), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString().replace("Scan ExistingRDD", ""))


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("held", held_out("doc_id", 5, 0))
    model = langid.fit(docs.where("not held"))
    told = langid.predict(docs, model).where("held")
    assert told.where("lang = lang_pred").count() >= 0.98 * told.count()
    odd = {key(r["text"]): (r["lang_pred"], r["score"]) for r in langid.predict(data.frame(spark), model).collect()}
    assert odd[-1] == odd[""] == odd["12 34 !!"] == ("und", 0.0)
    assert odd["日本語 テスト  x"][0] in model.languages
    assert all(0 <= s <= 1 for _, s in odd.values())
    empty = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(data.frame(spark), empty).collect()} == {"und"}
    assert langid.predict(data.frame(spark, []), model).count() == 0


def test_language_scores_are_near_those_of_exact_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang is not null").select("doc_id", "text", "lang")
    rows, model = docs.collect(), langid.fit(docs)
    fold = lambda t: re.sub(rb" +", b" ", bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in (t or "").encode()))
    grams = lambda t: [x[i : i + 4] for x in [fold(t)] for i in range(len(x) - 3)]
    seen = {k: collections.Counter(g for r in rows if r["lang"] == k for g in grams(r["text"])) for k in model.languages}
    rates = {k: {g: n / sum(x for x in c.values() if x >= langid.MIN_COUNT) for g, n in c.items() if n >= langid.MIN_COUNT} for k, c in seen.items()}
    held = {k: {g for g, x in c.items() if x >= langid.MIN_SHARE * max(o.get(g, 0) for o in rates.values())} for k, c in rates.items()}
    for r in langid.predict(docs, model, evidence=("grams", "known")).collect():
        g = grams(r["text"])
        hits = {k: sum(x in held[k] for x in g) for k in model.languages}
        top, total = max(hits.values()), sum(hits.values())
        assert r["grams"] == len(g)
        if r["lang_pred"] != "und" and total > 50:
            assert hits[r["lang_pred"]] >= top - 0.01 * len(g)
            assert r["score"] == pytest.approx(top / total, abs=0.02) and r["known"] == pytest.approx(top / len(g), abs=0.02)


def test_filters_hold_every_ngram_and_few_others(spark):
    many = spark.createDataFrame([(i, "".join(chr(97 + (i * 7 + j * j) % 26) for j in range(40)), f"l{i % 11}") for i in range(200)], "doc_id long, text string, lang string")
    model = langid.fit(many)  # more languages than bits of one word
    assert model.masks.shape[1] == 2 and len(model.languages) == 11
    assert (model.chance < 0.01).all()


def test_scores(spark, tmp_path):
    rows = data.rows()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    count = collections.Counter(x for r in rows if not held(r[0]) for x in [*data.words(data.lowered(r[1])), None])
    n, v = sum(count.values()), len(count)
    docs = data.frame(spark, rows).withColumn("training", ~held_out("doc_id", 7, 2))
    for hot in (1 << 18, 40):  # few frequent words: most counts are joined
        maxent.HOT, before = hot, maxent.HOT
        got = maxent.score(docs, folder=f"file://{tmp_path}/{hot}").collect()
        maxent.HOT = before
        told = sorted((key(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
        want = []
        for r in rows:
            w = [*data.words(data.lowered(r[1])), None]
            want.append((key(r[0]), held(r[0]), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
        assert told == sorted(want)
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    none = maxent.score(docs.withColumn("training", F.lit(False)), folder=f"file://{tmp_path}/none").collect()
    assert all(r["score"] == r["base_score"] == 0 for r in none)
    assert maxent.score(docs.limit(0), folder=f"file://{tmp_path}/empty").count() == 0


def test_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").withColumn("training", ~held_out("doc_id", 7, 2))
    r = maxent.score(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def test_fingerprints(spark):
    rows = data.rows()
    ordered = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -10), r[1] is not None, r[1] or ""))
    want = []
    for i, r in enumerate(ordered):
        t, nxt = r[1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        k = len(t) // 2
        want.append((key(r[0]), len(t), hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest()))
    got = minhash.fingerprints(data.frame(spark, rows)).collect()
    assert sorted((key(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    by = collections.defaultdict(set)
    for r in got:
        by[r["edited_sha256"]].add(r["edited_fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(x) == 1 for x in by.values())
    assert minhash.fingerprints(data.frame(spark, rows[:1])).first()["near_next"] == 1.0
    assert minhash.fingerprints(data.frame(spark, [])).count() == 0
    nulls = minhash.fingerprints(data.frame(spark, [(None, "a b c d e f g", *[None] * 11), (None, None, *[None] * 11)])).collect()
    assert len(nulls) == 2


def test_likeness_estimates_jaccard():
    import numpy as np
    import pyarrow as pa

    a, b = " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(100, 500))
    x, y = shingles(a, 5), shingles(b, 5)
    s = minhash.sign(pa.array([a, b]))
    assert abs(minhash.likeness(s[:1], s[1:])[0] - len(x & y) / len(x | y)) < 0.15
    assert (minhash.sign(pa.array([a, a]))[0] == s[0]).all() and np.array_equal(minhash.sign(pa.array(["", None]))[0], minhash.sign(pa.array([""]))[0])


def test_lm_score_is_that_of_a_plain_softmax(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(maxent, "HOT", 40)
    docs = data.frame(spark).select("doc_id", "text").withColumn("training", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    learned = docs.where("training")
    _, known = maxent.gather(learned, f"file://{tmp_path}/counts")
    weights, cell_weights, bias, cell_bias = model = maxent.train(learned, known)
    monkeypatch.setattr(maxent, "train", lambda *_: model)
    got = {(key(r["doc_id"]), r["n_tokens"], round(r["base_score"], 6)): r["score"] for r in maxent.score(docs, folder=f"file://{tmp_path}/scored").collect()}

    plain = lambda t: data.words(data.lowered(t))
    counts = collections.Counter(x for r in learned.collect() for x in plain(r["text"]))
    cells = {}
    cell_of = lambda x, i: (int(x.classes[i]), int(x.cells[list(x.of).index(i)]) if i in set(x.of.tolist()) else -1)
    for word in counts:
        w = textkernel.words(pa.array([word]), lower=True)
        at = cell_of(maxent.features(w, w.hashes(), known), 0)
        held = cells.setdefault(at, [0, 0])
        held[0], held[1] = held[0] + counts[word], held[1] + 1
    cells[maxent.HEADS, -1] = [learned.count(), 1]
    n, v = sum(c[0] for c in cells.values()), sum(c[1] for c in cells.values())
    assert max(len([c for c in cells if c[0] == k]) for k in range(maxent.CLASSES)) > 5

    def share(w, b, rows, told):
        e = [math.exp(sum(float(w[r, k]) for r in rows) + float(b[k])) for k in range(len(b))]
        return e[told] / sum(e)

    for r in docs.collect()[::4]:
        w = textkernel.words(pa.array([r["text"]], pa.string()), lower=True)
        x = maxent.features(w, w.hashes(), known)
        score = base = 0.0
        for i, word in enumerate([*plain(r["text"]), None]):
            c, cell = cell_of(x, i)
            score += math.log10(share(weights, bias, x.rows[i], c))
            if cell >= 0:
                j = list(x.of).index(i)
                score += math.log10(share(cell_weights, cell_bias[c - maxent.HEADS - 1], x.cell_rows[j], cell))
            seen = learned.count() if word is None else counts[word]
            tokens, distinct = cells.get((c, cell), (0, 0))
            score += math.log10((seen + 1) / (tokens + distinct + 1))
            base += math.log10((seen + 1) / (n + v + 1))
        assert got[key(r["doc_id"]), len(plain(r["text"])) + 1, round(base, 6)] == pytest.approx(score, abs=1e-3 * (1 + len(x.classes) / 50))

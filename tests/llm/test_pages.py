"""URL rules and WARC archives."""

from __future__ import annotations

import base64
import collections
import hashlib
import random

import pytest

from tessera.llm import files, urlfilter, warc

URLS = [
    None, "", "no scheme", "http://a.example.org/es/1", "http://example.org/en/12?x=1", "https://EXAMPLE.org/en/2", "http://b.com/fr/x", "http://b.com/de/#y", "http://notexample.org/es/",
    "http://com", "http://x.net/casino/", "ftp://c.org?q", "http://example.org:80/es/", "http://a.com/FR/", "http://x.doubleclick.net/a", "http://fr.com/fr/", "://org/",
]


def judged(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(3, URLS[3], None, None)], "page_id long, url string, rule string, token string")
    for block in (urlfilter.BLOCK_RULES, 2):  # rules in several passes
        before, urlfilter.BLOCK_RULES = urlfilter.BLOCK_RULES, block
        got = urlfilter.judge(pages, ["page_id"]).collect()
        urlfilter.BLOCK_RULES = before
        assert len(got) == pages.count()
        for r in got:
            host, path, rule, verdict = judged(URLS[r["page_id"]])
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert r["verdict"] == (verdict or ("block" if r["pattern"] else "allow"))
        assert {r["page_id"] for r in got if r["pattern"]} == {10, 14}
    assert urlfilter.judge(pages.limit(0), ["page_id"]).count() == 0


def test_archives(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, f"http://x/{i}\r\nX: y", rng.choice([None, "", "same", "t" * 10, f"own {i} " + "é" * rng.randint(0, 3000), "\x1f\x8b\x08 magic"])) for i in range(120)]
    rows += [rows[0], (None, None, "same"), (None, "u", "only nulls"), (None, "v", "only nulls"), (119, "u", "big" * 200_000)]
    pages = spark.createDataFrame([(*r, "a", 1) for r in rows], "page_id long, url string, html string, sha string, newest long")
    for least in (0, 5):
        groups = collections.defaultdict(list)
        for p, _, h in rows:
            groups[h or ""].append(-1 if p is None else p)
        want = []
        for p, _, h in rows:
            b, top = (h or "").encode(), max(groups[h or ""])
            again = (-1 if p is None else p) != top and len(b) >= least
            want.append((-1 if p is None else p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", top if again else None))
        manifest = warc.write(pages, f"file://{tmp_path}/{least}", least)
        for split in (warc.SPLIT_BYTES, 700):  # small ranges begin within members
            got = [(-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, warc.read(manifest, split).collect())]
            assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.read(warc.write(pages.limit(0), f"file://{tmp_path}/none")).count() == 0


def test_damage_is_noticed(tmp_path):
    data = warc.record(1, "http://a/", b"payload", None, False)
    assert warc.parse(warc.zlib.decompress(data, 31))[:2] == (1, 7)
    with pytest.raises(ValueError):
        warc.parse(warc.zlib.decompress(data, 31).replace(b"payload", b"paxload"))
    place = f"file://{tmp_path}/x.warc.gz"
    with files.create(place) as out:
        out.write(b"\x1f\x8b\x08junk" + data + b"\x1f\x8b\x08" + data[: len(data) // 2])
    with files.open_input(place) as file:
        assert len(list(warc.members(file, 0, file.size()))) == 1

"""Small documents with every awkward row: nulls, blanks, ties, repeats, copies, long words, clashing columns."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, part int, spans string, ids string, rid long, offset int, seed int, score double"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(n: int = 60, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioutrnslé") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    text = lambda k: " ".join(rng.choice(vocabulary).title() if rng.random() < 0.1 else rng.choice(vocabulary) for _ in range(k))
    passage, texts = text(60), []
    for i in range(n):
        t = text(rng.choice([2, 12, 40, 90, 200]))
        if i % 9 == 0:
            t = f"{t}\n{passage} {t[:40]}"
        texts.append(t)
    texts += [texts[7], texts[7], texts[11] + " extra", " ".join(words(texts[12])[1:]), passage, passage + "\n" + passage]
    texts += [None, "", "   ", "\t\n", "a", "A b", "12 34 !!", "日本語 テスト  x", "y" * 3000, ("long " + text(30) + " ") * 60, "it's 's <|endoftext|>  z\n\n w \x0b v"]
    out = [(i, t, rng.choice(["en", "fr", None]), "s", len(t or ""), 1, 2, "x", "y", 3, 4, 5, 0.5) for i, t in enumerate(texts)]
    return out + [out[0], (None, texts[3], "en", None, None, None, None, None, None, None, None, None, None), (None, None, *[None] * 11), (5, "another text of a tied id", *[None] * 11)]


def frame(spark, given=None):
    return spark.createDataFrame(rows() if given is None else given, SCHEMA)

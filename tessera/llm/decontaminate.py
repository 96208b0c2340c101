"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Texts become runs of letters and digits in lower case; in scripts written without spaces (UNSPACED)
each letter, mark and digit is a token of its own. A seed is a hash of the tokens that a fixed
mask selects; the positions it ignores may differ. Training seeds are joined with the benchmark's;
each hit lays the whole item over the document at one offset. The item is found there if some WINDOW
aligned tokens in a row (all of a shorter item) agree in SHARE of their positions at least.

Items of fewer than SEED_TOKENS tokens must agree whole, so they are one seed of their own length;
items of 5 and 6 tokens have the seeds of NARROW, as the others miss some of their substitutions.
Documents get those seeds only if the benchmark has such items. Null texts and items without tokens
hold nothing; null ids of documents are ids like others, items without an id aren't looked for. Documents of equal id are found together, each text aligned by itself; ties of items and
offsets give the best alignment of each item. Empty tables find nothing. The benchmark is broadcast
below MOST_SEEDS seeds; beyond that, seeds are joined by a shuffle and documents are read again for
the alignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions that each mask selects: fixed masks, chosen to hit texts with a fifth of their tokens replaced.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 4, 5, 6), (0, 1, 3, 7, 8))
SEED_TOKENS = 5
#: Masks of items of SEED_TOKENS tokens and one more: every single substitution leaves a seed.
NARROW = ((0, 1, 2), (0, 1, 3, 4))
#: MASKS, NARROW, and whole items of 1 to SEED_TOKENS - 1 tokens.
ALL_MASKS = MASKS + NARROW + tuple(tuple(range(n)) for n in range(1, SEED_TOKENS))
#: Thai, Lao, Myanmar, Khmer, Tai Le to Tai Tham, kana, Bopomofo, Han; a class of Java's patterns.
UNSPACED = "[[\\u0E00-\\u0EFF\\u1000-\\u109F\\u1780-\\u17FF\\u1950-\\u19FF\\u1A20-\\u1AAF\\u3005-\\u3007\\u3040-\\u312F\\u31A0-\\u31BF\\u31F0-\\u31FF\\u3400-\\u4DBF\\u4E00-\\u9FFF\\uF900-\\uFAFF\\uFF66-\\uFF9F\\x{20000}-\\x{3FFFF}]&&[\\p{L}\\p{M}\\p{N}]]"
WINDOW, SHARE = 13, (4, 5)
MOST_SEEDS = 400_000


def tokens(text: str) -> Column:
    """Hashes of a text's tokens."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    apart = F.regexp_replace(low, f"({UNSPACED})", " $1 ")
    # Marks count in such scripts only, so texts without them are cut as ever.
    pieces = F.regexp_extract_all(apart, F.lit(f"{UNSPACED}|[\\p{{L}}\\p{{N}}]+"), F.lit(0))
    parts = F.when(low.rlike(UNSPACED), pieces).otherwise(F.split(low, "[^\\p{L}\\p{N}]+"))
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.xxhash64(x))


def _once(value: Column) -> Column:
    """value computed once for each row: the optimiser doesn't copy a generator's output into the lambdas that use it."""
    return F.explode(F.array(value))


def seeds(hashed: str, masks: list[int]) -> list[Column]:
    """For each of the masks by number, the seeds at all positions."""
    out = []
    for k in masks:
        mask = ALL_MASKS[k]
        n = F.size(hashed) - mask[-1]
        picked = ", ".join(f"{hashed}[i + {p}]" for p in mask)
        out.append(F.when(n > 0, F.expr(f"transform(sequence(0, size({hashed}) - {mask[-1] + 1}), i -> xxhash64({k}, {picked}))")).otherwise(F.array().cast("array<bigint>")))
    return out


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    return benchmark.select(F.col(item_id).alias("item_id"), _once(tokens(text)).alias("it")).where(F.size("it") > 0)


def _suits(k: int) -> Column:
    """Whether items of this size have seeds of mask k."""
    n, narrow = F.size("it"), len(MASKS) + len(NARROW)
    return n > SEED_TOKENS + 1 if k < len(MASKS) else n.between(SEED_TOKENS, SEED_TOKENS + 1) if k < narrow else n == len(ALL_MASKS[k])


def _item_seeds(items: DataFrame) -> DataFrame:
    made = enumerate(seeds("it", list(range(len(ALL_MASKS)))))
    each = F.array(*[F.struct(F.lit(k).alias("mask"), F.when(_suits(k), s).otherwise(F.array().cast("array<bigint>")).alias("s")) for k, s in made])
    return items.select("item_id", F.explode(each).alias("m")).select("item_id", F.col("m.mask").alias("mask"), F.posexplode("m.s").alias("place", "seed"))


def _alignment(offset: str) -> tuple[Column, Column]:
    """Whether each token of `it` laid over `dt` at the offset agrees (1 or 0), and the window's tokens."""
    low = F.greatest(F.lit(0), -F.col(offset))
    length = F.least(F.size("it"), F.size("dt") - F.col(offset)) - low
    same = F.zip_with(F.slice("dt", F.col(offset) + low + 1, length), F.slice("it", low + 1, length), lambda a, b: (a == b).cast("int"))
    return same, F.least(F.size("it"), F.lit(WINDOW))


def found(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text", most_seeds: int = MOST_SEEDS) -> DataFrame:
    """Per keys of docs and item found there: item_id, n_item_tokens, n_agreeing (in the best window)."""
    items = _items(benchmark, item_id, item_text)
    wanted = _item_seeds(items)
    per_mask = {r["mask"]: r["count"] for r in wanted.groupBy("mask").count().collect()}
    small, masks = sum(per_mask.values()) <= most_seeds, sorted(per_mask) or [0]
    # The text is part of a row's key, so that rows of one id and different texts are aligned each by itself.
    keyed = [*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key_text")]
    hashed = docs.select(*keyed, _once(tokens(text)).alias("dt"))
    shown = [f"key_{i}" for i in range(len(keys))]
    names = [*shown, "key_text"]
    # A column of its own, so that explode and join are one compiled stage and dt is copied for hits only.
    each = hashed.withColumn("seeds", F.concat(*seeds("dt", masks))).select(*names, "dt", F.size("dt").alias("n"), F.posexplode_outer("seeds").alias("at", "seed"))
    joined = each.join(F.broadcast(wanted), "seed") if small else each.drop("dt").join(wanted, "seed")
    before = F.lit(0)
    start = F.lit(0)
    for k, after in zip(masks, masks[1:], strict=False):  # positions of a mask's seeds begin after those of the masks before
        before = before + F.greatest(F.lit(0), F.col("n") - ALL_MASKS[k][-1])
        start = F.when(F.col("mask") == after, before).otherwise(start)
    offset = (F.col("at") - start - F.col("place")).alias("offset")
    if small:
        hits = joined.select(*names, "item_id", offset, "dt").join(F.broadcast(items), "item_id")
    else:
        at = joined.select(*names, "item_id", offset).distinct()
        same = F.lit(True)
        again = hashed.select(*[F.col(n).alias(f"again_{n}") for n in names], "dt")
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"again_{n}"))
        hits = at.join(again, same).select(*names, "item_id", "offset", "dt").join(items, "item_id")
    same, wide = _alignment("offset")
    laid = hits.select(*names, "item_id", F.size("it").alias("n_item_tokens"), wide.alias("wide"), _once(same).alias("same")).where(F.size("same") >= F.col("wide"))
    sums = F.transform(F.sequence(F.lit(1), F.size("same") - F.col("wide") + 1), lambda i: F.aggregate(F.slice("same", i, F.col("wide")), F.lit(0), lambda s, x: s + x))
    judged = laid.select(*names, "item_id", "n_item_tokens", "wide", _once(F.array_max(sums)).alias("n_agreeing"))
    judged = judged.where(F.col("n_agreeing") * SHARE[1] >= F.col("wide") * SHARE[0])
    out = judged.groupBy(*shown, "item_id").agg(F.max("n_item_tokens").alias("n_item_tokens"), F.max("n_agreeing").alias("n_agreeing"))
    return out.select(*[F.col(n).alias(k) for n, k in zip(shown, keys, strict=True)], "item_id", "n_item_tokens", "n_agreeing")


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs in whose text no item is found."""
    keyed = docs.withColumns({"__d": F.col(doc_id), "__t": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    hit = found(keyed, benchmark, ["__d", "__t"], text).select(F.col("__d").alias("__hd"), F.col("__t").alias("__ht")).distinct()
    return keyed.join(hit, F.col("__d").eqNullSafe(F.col("__hd")) & (F.col("__t") == F.col("__ht")), "left_anti").drop("__d", "__t")

"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) * P(cell | class, before) * P(word | cell). The HEADS most frequent
words are classes of their own, so is the end of a document; other words are classed by their last two
bytes. Such a class has a cell for each of its NAMED most frequent words, and OTHERS cells for the rest
by hash. Class and cell are each given by a log-linear model over hashed features: the word before
(bigram), the one before that (skip) and both (trigram), in the cell's model together with the class; a
rare word stands there by its last two bytes. Within a cell of several words a word's weight is its
unigram feature alone, whose best fit is its relative count, smoothed by one.

Counts of words cover all training documents. The weights are trained in ROUNDS, each on an equal
share of the training documents by hash, every document once: tasks run minibatch gradient updates
from the shared weights, and their changes are averaged row by row, weighted by use, in a tree.
Scoring takes sparse minibatches of numpy. The most frequent words' counts (HOT at most) are
broadcast; all others' are joined exactly.

A null or empty text is the end token alone. Rows are scored each by itself, so repeated rows, ties
and null ids get equal scores for equal texts. Without training documents every count is 0 and the
score is the base score. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import array_sums, checkpointed, prepare, shared_dir, slices
from .textkernel import U, Words, mix, words

HOT, CONTEXT = 1 << 18, 1 << 13
HEADS, FORMS = 15, 16
CLASSES = HEADS + 1 + FORMS
NAMED, OTHERS = 24, 8
CELLS = NAMED + OTHERS
#: Rows of bigram, skip and trigram features, of the classes' model and of the cells'; each has 2**16 at most.
ROWS, CELL_ROWS = (1 << 13, 1 << 13, 1 << 14), (1 << 14, 1 << 13, 1 << 14)
BATCH, RATE, ROUNDS = 4096, 1.0, 2
_BOS = np.uint64(0x5851F42D4C957F2D)


def suffix(w: Words) -> np.ndarray:
    """Last two bytes of each word as a number."""
    if not len(w.end):
        return np.zeros(0, np.int64)
    last = w.data[w.end - 1].astype(np.int64)
    return last * 256 + np.where(w.end - w.start > 1, w.data[w.end - 2], 0)


def form(s: np.ndarray) -> np.ndarray:
    return (s * 40503 >> 4) % FORMS


@dataclass
class Counts:
    """What training documents say of words: the frequent ones in order of their hashes, and sums."""

    hashes: np.ndarray
    n: np.ndarray
    heads: np.ndarray  # sorted hashes of words that are classes; head_class gives which
    head_class: np.ndarray
    named: np.ndarray  # sorted hashes of words that are cells; named_cell gives which of their class
    named_cell: np.ndarray
    context: np.ndarray  # sorted hashes of words that stand for themselves as context
    cell_tokens: np.ndarray  # of classes that are one word, then of the other classes' cells
    cell_words: np.ndarray
    tokens: int
    distinct: int
    documents: int

    def count(self, h: np.ndarray) -> np.ndarray:
        """Count of each frequent word, -1 for others."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.n[at], -1)

    def classes(self, h: np.ndarray, forms: np.ndarray) -> np.ndarray:
        return _looked_up(self.heads, self.head_class, h, HEADS + 1 + forms)

    def cells(self, h: np.ndarray) -> np.ndarray:
        """Cell of each word within its class, if that has cells."""
        return _looked_up(self.named, self.named_cell, h, NAMED + ((h >> U(20)) % U(OTHERS)).astype(np.int64))

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Log shares of the classes, and of the cells in each class that has some."""
        cells = self.cell_tokens[HEADS + 1 :].reshape(FORMS, CELLS)
        classes = np.concatenate([self.cell_tokens[: HEADS + 1], cells.sum(axis=1)]) + 1
        return np.log(classes / classes.sum()).astype(np.float32), np.log((cells + 1) / (cells + 1).sum(axis=1, keepdims=True)).astype(np.float32)


def _looked_up(known: np.ndarray, values: np.ndarray, h: np.ndarray, default: np.ndarray) -> np.ndarray:
    if not len(known):
        return default
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, values[at], default)


def tally(training: DataFrame) -> DataFrame:
    """h, f, n of the words of training documents, as counted by each task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, forms, n = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(forms), pa.array(n)], names=["h", "f", "n"])

        for batch in slices(batches, "text"):
            w = words(batch.column("text"), lower=True)
            k, at, c = np.unique(w.hashes(), return_index=True, return_counts=True)
            keys, first, back = np.unique(np.concatenate([keys, k]), return_index=True, return_inverse=True)
            forms = np.concatenate([forms, form(suffix(w)[at])])[first]
            n = np.bincount(back, weights=np.concatenate([n, c]), minlength=len(keys)).astype(np.int64)
            if len(keys) > 1_000_000:
                yield out()
                keys, forms, n = keys[:0], forms[:0], n[:0]
        if len(keys):
            yield out()

    return training.select("text").mapInArrow(rows, "h long, f long, n long")


def gather(training: DataFrame, folder: str) -> tuple[DataFrame, Counts]:
    """All words' counts as a table, and what is broadcast of them."""
    vocabulary = checkpointed(tally(training).groupBy("h").agg(F.max("f").alias("f"), F.sum("n").alias("n")), folder, "vocabulary")
    documents = training.count()
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.log2("n") * 16) - 32)  # counts in steps of a few per cent: some hundred rows
    spread = vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n")).orderBy(F.desc("n")).toPandas()
    room = spread["words"].cumsum() <= HOT
    least = int(spread["n"][room].min()) if room.any() else (int(spread["n"].max()) + 1 if len(spread) else 1)
    hot = vocabulary.where(F.col("n") >= least).toPandas()
    h, n, f = hot["h"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64), hot["f"].to_numpy(np.int64)
    order = np.lexsort((h, -n))
    heads, context = order[:HEADS], order[:CONTEXT]
    left = order[HEADS:]
    named = [left[f[left] == k][:NAMED] for k in range(FORMS)]
    own, cell = np.concatenate(named), np.concatenate([np.arange(len(x)) for x in named]).astype(np.int64)
    hashed = F.pmod(F.shiftrightunsigned("h", 20), F.lit(OTHERS))
    by_cell = vocabulary.groupBy("f", hashed.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    tokens, distinct = np.zeros((FORMS, CELLS), np.int64), np.zeros((FORMS, CELLS), np.int64)
    place = by_cell["f"].to_numpy(np.int64), NAMED + by_cell["c"].to_numpy(np.int64)
    tokens[place], distinct[place] = by_cell["n"], by_cell["v"]
    for words_ in (heads, own):  # these leave the cells of their hashes
        at = f[words_], NAMED + ((h[words_] >> U(20)) % U(OTHERS)).astype(np.int64)
        np.subtract.at(tokens, at, n[words_])
        np.subtract.at(distinct, at, 1)
    tokens[f[own], cell], distinct[f[own], cell] = n[own], 1
    single, ones = np.zeros(HEADS + 1, np.int64), np.zeros(HEADS + 1, np.int64)
    single[: len(heads)], ones[: len(heads)] = n[heads], 1
    single[HEADS], ones[HEADS] = documents, int(documents > 0)
    cell_tokens, cell_words = np.concatenate([single, tokens.reshape(-1)]), np.concatenate([ones, distinct.reshape(-1)])
    sort, first, second = np.argsort(h), np.argsort(h[heads]), np.argsort(h[own])
    counts = Counts(h[sort], n[sort], h[heads][first], first, h[own][second], cell[second], np.sort(h[context]), cell_tokens, cell_words, int(cell_tokens.sum()), int(cell_words.sum()), documents)
    return vocabulary.where(F.col("n") < least), counts


@dataclass
class Features:
    """Tokens of a slice of texts, each text with its end: rows (3 a token) and class; of those in `of`, rows and cell within the class."""

    rows: np.ndarray
    classes: np.ndarray
    of: np.ndarray
    cell_rows: np.ndarray
    cells: np.ndarray
    first: np.ndarray

    def batches(self) -> Iterator[tuple[slice, slice]]:
        """Minibatches of tokens, and of those that have cells."""
        for i in range(0, len(self.rows), BATCH):
            yield slice(i, i + BATCH), slice(*np.searchsorted(self.of, [i, i + BATCH]).tolist())


def features(w: Words, h: np.ndarray, counts: Counts) -> Features:
    s = suffix(w)
    docs = len(w.first) - 1
    first = w.first + np.arange(docs + 1)
    n = int(first[-1])
    place = np.arange(len(h)) + w.doc
    classes = np.full(n, HEADS, np.int64)
    classes[place] = counts.classes(h, form(s))
    cells = np.zeros(n, np.int64)
    cells[place] = counts.cells(h)
    own = np.zeros(len(h), bool)
    if len(counts.context):
        at = np.minimum(np.searchsorted(counts.context, h), len(counts.context) - 1)
        own = counts.context[at] == h
    told = np.full(n + 2, _BOS, U)
    told[place + 2] = np.where(own, h, mix(s.astype(U) + U(77)))
    one, two = told[1 : n + 1].copy(), told[:n].copy()
    one[first[:-1]] = _BOS
    two[first[:-1]] = _BOS
    second = first[:-1] + 1
    two[second[second < first[1:]]] = _BOS
    values = (one, two + U(1), one * U(3) + mix(two))
    of = np.flatnonzero(classes > HEADS)
    salt = classes[of].astype(U) * U(0x9E3779B97F4A7C15)
    rows, cell_rows = np.empty((n, 3), np.int64), np.empty((len(of), 3), np.int64)
    for k, x in enumerate(values):
        rows[:, k] = sum(ROWS[:k]) + (mix(x) & U(ROWS[k] - 1)).astype(np.int64)
        cell_rows[:, k] = sum(CELL_ROWS[:k]) + (mix(x[of] + salt) & U(CELL_ROWS[k] - 1)).astype(np.int64)
    return Features(rows, classes, of, cell_rows, cells[of], first)


def log_odds(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """exp of logits less their maximum. bias: one row for all, or one each."""
    x = weights[rows[:, 0]]
    x += weights[rows[:, 1]]
    x += weights[rows[:, 2]]
    x += bias
    x -= x.max(axis=1, keepdims=True)
    return np.exp(x, out=x)


def update(weights: np.ndarray, bias: np.ndarray, used: np.ndarray, rows: np.ndarray, told: np.ndarray) -> None:
    """One minibatch's gradient step towards the classes or cells told, in place; used counts each row's tokens so far."""
    if not len(rows):
        return
    p = log_odds(weights, bias, rows)
    p /= -p.sum(axis=1, keepdims=True)
    p[np.arange(len(p)), told] += 1  # observed less expected
    for k in range(3):
        order = np.argsort(rows[:, k].astype(np.uint16), kind="stable")
        sorted_rows = rows[order, k]
        begin = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
        at = sorted_rows[begin]
        m = np.diff(begin, append=len(order)).astype(np.float32)
        used[at] += m
        step = np.add.reduceat(p[order], begin, axis=0)
        step *= (RATE / (2 + np.sqrt(m * used[at])))[:, None]
        weights[at] += step


def train(training: DataFrame, counts: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the classes' model and of the cells' (feature row, class or cell), and the biases of both."""
    spark = training.sparkSession
    bias, cell_bias = counts.biases()
    weights, cell_weights = np.zeros((sum(ROWS), CLASSES), np.float32), np.zeros((sum(CELL_ROWS), CELLS), np.float32)
    for r in range(ROUNDS if counts.documents else 0):
        given = spark.sparkContext.broadcast((weights, cell_weights, bias, cell_bias, counts))

        def learn(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            base, cell_base, prior, cell_prior, known = given.value
            own, cell_own = base.copy(), cell_base.copy()
            used, cell_used = np.zeros(len(base), np.float32), np.zeros(len(cell_base), np.float32)
            for batch in slices(batches, "text"):
                w = words(batch.column("text"), lower=True)
                x = features(w, w.hashes(), known)
                for all_, some in x.batches():
                    update(own, prior, used, x.rows[all_], x.classes[all_])
                    update(cell_own, cell_prior[x.classes[x.of[some]] - HEADS - 1], cell_used, x.cell_rows[some], x.cells[some])
            out = [(own - base).astype(np.float16), used, (cell_own - cell_base).astype(np.float16), cell_used]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in out], names=["change", "used", "cell_change", "cell_used"])

        def weighted(x: list[np.ndarray]) -> list[np.ndarray]:
            times = lambda change, used: (change.astype(np.float32).reshape(len(used), -1) * used[:, None]).reshape(-1)
            return [times(x[0], x[1]), x[1], times(x[2], x[3]), x[3]]

        share = training.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == r).select("text")
        sums = array_sums(share.mapInArrow(learn, "change binary, used binary, cell_change binary, cell_used binary"), [np.float16, np.float32] * 2, weighted)
        if sums:
            weights = weights + sums[0].reshape(-1, CLASSES) / np.maximum(sums[1], 1)[:, None]
            cell_weights = cell_weights + sums[2].reshape(-1, CELLS) / np.maximum(sums[3], 1)[:, None]
    return weights.astype(np.float32), cell_weights.astype(np.float32), bias, cell_bias


def log_probabilities(x: Features, model: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 of P(class) and P(cell) of each token."""
    weights, cell_weights, bias, cell_bias = model
    logs = np.empty(len(x.classes))
    for all_, some in x.batches():
        p = log_odds(weights, bias, x.rows[all_])
        logs[all_] = np.log10(p[np.arange(len(p)), x.classes[all_]] / p.sum(axis=1))
        if some.stop > some.start:
            p = log_odds(cell_weights, cell_bias[x.classes[x.of[some]] - HEADS - 1], x.cell_rows[some])
            logs[x.of[some]] += np.log10(p[np.arange(len(p)), x.cells[some]] / p.sum(axis=1))
    return logs


def score(docs: DataFrame, training: str = "training", folder: str | None = None) -> DataFrame:
    """Per row of docs (doc_id, text, training boolean): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or shared_dir(spark)
    docs = docs.select("doc_id", "text", F.col(training).alias("training"))
    learned = docs.where("training")
    tail, counts = gather(learned, folder)
    shared = spark.sparkContext.broadcast((*train(learned, counts), counts))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        *model, known = shared.value
        rid = TaskContext.get().partitionId() << 40
        size = np.log10(known.cell_tokens + known.cell_words + 1.0)
        for batch in slices(batches, "text"):
            w = words(batch.column("text"), lower=True)
            h = w.hashes()
            x = features(w, h, known)
            first, logs = x.first, log_probabilities(x, model)
            cell = x.classes.copy()
            cell[x.of] = HEADS + 1 + (x.classes[x.of] - HEADS - 1) * CELLS + x.cells
            logs -= size[cell]
            counted = known.count(h)
            worth = np.concatenate([[0], np.cumsum(np.where(counted >= 0, np.log10(np.maximum(counted, 0) + 1.0), 0))])
            seen = np.concatenate([[0], np.cumsum(counted > 0)])
            rare = np.flatnonzero(counted < 0)
            n = batch.num_rows
            edge = np.searchsorted(rare, w.first).astype(np.int32)
            ends = int(known.documents > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(rid, rid + n)),
                    batch.column("doc_id"),
                    batch.column("training"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(np.diff(seen[w.first]) + ends, pa.int64()),
                    pa.array(np.diff(worth[w.first]) + np.log10(known.documents + 1.0)),
                    pa.array(np.add.reduceat(logs, first[:-1]) if n else np.zeros(0)),
                    pa.ListArray.from_arrays(pa.array(edge), pa.array(h[rare].view(np.int64))),
                ],
                names=["rid", "doc_id", "training", "n_tokens", "n_known", "worth", "logs", "rare"],
            )
            rid += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = checkpointed(docs.mapInArrow(rows, f"rid long, doc_id {kind}, training boolean, n_tokens long, n_known long, worth double, logs double, rare array<long>"), folder, "scored")
    more = scored.select("rid", F.explode("rare").alias("h")).join(tail.select("h", "n"), "h").groupBy("rid").agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("n") + 1)).alias("more_worth"))
    out = scored.drop("rare").join(more, "rid", "left")
    worth = F.col("worth") + F.coalesce("more_worth", F.lit(0.0))
    base = float(np.log10(counts.tokens + counts.distinct + 1.0))
    return out.select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (worth - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (worth + F.col("logs") if counts.documents else worth - F.col("n_tokens") * F.lit(base)).alias("score"),
    )

"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

A word is the average of the embeddings of its hashed character n-grams (bytes,
with word ends), a window of WINDOW words the average of its words, and a
linear softmax reads the window; embeddings and softmax are trained jointly in
numpy. Unseen misspellings share n-grams with seen words. A document scores as
its most toxic window, so one insult in a long text isn't averaged away.

The fit uses at most MAX_TRAIN labelled rows of each class (by hash of the id)
and runs in one Spark task; the model has a fixed size and scoring is one pass
over the texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.llm import textvec as V

BITS, DIM, WINDOW, GRAMS = 17, 8, 2, (3, 4, 5, 6)
#: Labelled rows of each class in the fit at most.
MAX_TRAIN = 1_500
#: Steps over all windows, rounds of picking windows and steps on the picked ones.
WARM, ROUNDS, STEPS, RATE = 5, 10, 12, 0.1
#: Windows of a document that are learnt from in a round, and the clean ones' share of the loss.
TOP_TOXIC, TOP_CLEAN, CLEAN_SHARE = 1, 8, 0.6
LEAST_DOCS = 3
CUT = 0.7


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word numbers) of the n-grams of ``<word>`` and of the words themselves."""
    size = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(starts)), size)
    inner = np.arange(first[-1]) - first[:-1][word] - 1
    text = np.full(first[-1], 60, dtype=np.uint8)
    text[first[1:] - 1] = 62
    body = (inner >= 0) & (inner < (ends - starts)[word])
    text[body] = data[starts[word[body]] + inner[body]]
    codes, out, owner = V.BYTE_CODE[text], [V.span_hashes(text, first[:-1], first[1:])], [np.arange(len(starts))]
    with np.errstate(over="ignore"):
        for n in GRAMS:
            at = np.flatnonzero(np.arange(first[-1]) + n <= first[1:][word])
            h = np.zeros(len(at), dtype=V.U)
            for j in range(n):
                h += codes[at + j] * V.GRAM_CODE[j]
            out.append(V.mix(h + V.U(n)))
            owner.append(word[at])
    return (np.concatenate(out) >> V.U(64 - BITS)).astype(np.int64), np.concatenate(owner)


def without_repeats(w: V.Words) -> V.Words:
    """Words without those equal to the word before: a repeated word is one piece of evidence."""
    row = w.row_of()
    keep = np.ones(len(w.hashes), dtype=bool)
    keep[1:] = (w.hashes[1:] != w.hashes[:-1]) | (row[1:] != row[:-1])
    total = np.concatenate([[0], np.cumsum(keep)])
    return V.Words(w.hashes[keep], total[w.offsets], w.starts[keep], w.ends[keep])


def windows(w: V.Words) -> tuple[np.ndarray, np.ndarray]:
    """(window of each word, row of each window): runs of WINDOW words of a row."""
    at = np.arange(len(w.hashes)) - w.offsets[:-1][w.row_of()]
    per_row = -(-np.diff(w.offsets) // WINDOW)
    base = np.concatenate([[0], np.cumsum(per_row)])
    return base[:-1][w.row_of()] + at // WINDOW, np.repeat(np.arange(w.rows), per_row)


def ragged(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[first[i]: first[i] + count[i]] of all i, joined."""
    total = np.cumsum(count)
    return flat[np.repeat(first - (total - count), count) + np.arange(total[-1] if len(total) else 0)]


class Averages:
    """Sparse row averages: out[i] = mean of x[col] over the entries of row i (rows in order)."""

    def __init__(self, row: np.ndarray, col: np.ndarray, n_rows: int):
        self.col, self.n_rows = col, n_rows
        self.count = np.bincount(row, minlength=n_rows)
        self.some = np.flatnonzero(self.count)
        self.first = (np.cumsum(self.count) - self.count)[self.some]
        back = np.argsort(col, kind="stable")
        self.row_back = row[back]
        self.cols, self.first_back = np.unique(col[back], return_index=True)

    def forward(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n_rows, x.shape[1]), dtype=np.float32)
        if len(self.some):
            out[self.some] = np.add.reduceat(x[self.col], self.first) / self.count[self.some, None]
        return out

    def backward(self, g: np.ndarray, n_cols: int) -> np.ndarray:
        out = np.zeros((n_cols, g.shape[1]), dtype=np.float32)
        if len(self.cols):
            out[self.cols] = np.add.reduceat((g / np.maximum(self.count, 1)[:, None]).astype(np.float32)[self.row_back], self.first_back)
        return out


def train(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """(score of each n-gram bucket, bias) of the trained model: as the softmax is
    linear, a window's logit is its average over words of their average n-gram score."""
    hashes, win, row_of_win, keep, count = [], [], [], [], 0
    data, offsets = V.text_buffers(pa.array(texts, pa.string()))
    seen: dict = {}
    byte_parts = []
    for i, j in V.row_blocks(offsets):
        w = without_repeats(V.words_of(data, offsets[i:j + 1], V.NOT_ALNUM))
        own, (of, rows) = data[offsets[i]:offsets[j]], windows(w)
        hashes.append(w.hashes)
        win.append(of + count)
        row_of_win.append(rows + i)
        count += len(rows)
        values, at = np.unique(w.hashes, return_index=True)
        start = w.starts + (offsets[i:j + 1] - offsets[i])[w.row_of()]
        for v, a in zip(values.tolist(), at, strict=True):
            if v not in seen:
                seen[v] = len(seen)
                byte_parts.append(own[start[a]: start[a] + w.ends[a] - w.starts[a]].tobytes())
    if not seen or labels.min() == labels.max():
        return np.zeros(1 << BITS, dtype=np.float32), float(-4 if not len(labels) or labels.max() == 0 else 4)
    hashes, win, row_of_win = (np.concatenate(x) for x in (hashes, win, row_of_win))
    table = np.array(sorted(seen), dtype=V.U)
    number = np.array([seen[int(v)] for v in table])
    word = number[np.searchsorted(table, hashes)]
    ends = np.cumsum([len(b) for b in byte_parts])
    bucket, owner = subwords(np.frombuffer(b"".join(byte_parts), dtype=np.uint8), np.concatenate([[0], ends[:-1]]), ends)
    # n-grams of fewer than LEAST_DOCS documents are left out: their score would be chance
    doc_word = np.unique(np.stack([row_of_win[win], word]), axis=1)
    word_docs = np.bincount(doc_word[1], minlength=len(seen))
    gram_docs = np.bincount(bucket, weights=word_docs[owner], minlength=1 << BITS)
    often = gram_docs[bucket] >= LEAST_DOCS
    used, bucket = np.unique(bucket[often], return_inverse=True)
    owner = owner[often]
    if not len(used):
        return np.zeros(1 << BITS, dtype=np.float32), 0.0
    rng = np.random.default_rng(5)
    model = Model(np.zeros((len(used), DIM)), rng.normal(0, 0.5, (DIM, 2)), np.array([1.5, -1.5]))
    every = np.arange(count)
    inside = Bag(owner, bucket, win, word)
    y = labels[row_of_win]
    for _ in range(WARM):                              # every window has its document's label
        model.step(*inside.pick(every), y, *class_weights(y))
    order = np.argsort(row_of_win, kind="stable")
    for _ in range(ROUNDS):                            # a document is its most toxic windows
        p = model.predict(*inside.pick(every))
        best = order[np.lexsort((-p[order], row_of_win[order]))]
        first = np.searchsorted(row_of_win[best], row_of_win[best])
        place = np.arange(count) - first
        top = best[place < np.where(y[best] == 1, TOP_TOXIC, TOP_CLEAN)]
        parts = inside.pick(top)
        for _ in range(STEPS):
            model.step(*parts, y[top], *class_weights(y[top]))
    out = np.zeros(1 << BITS, dtype=np.float32)
    out[used] = model.emb @ (model.soft[:, 1] - model.soft[:, 0])
    return out, float(model.bias[1] - model.bias[0])


def class_weights(y: np.ndarray) -> tuple[float, float]:
    """Weights of a clean and of a toxic window: CLEAN_SHARE of the loss is on clean ones."""
    return CLEAN_SHARE / max(1, int((y == 0).sum())), (1 - CLEAN_SHARE) / max(1, int((y == 1).sum()))


class Bag:
    """n-grams of words and words of windows, from which averages over chosen windows are made."""

    def __init__(self, owner, bucket, win, word):
        self.grams = bucket[order := np.argsort(owner, kind="stable")]
        self.gram_count = np.bincount(owner, minlength=int(word.max()) + 1)
        self.gram_first = np.cumsum(self.gram_count) - self.gram_count
        self.words = word[order := np.argsort(win, kind="stable")]
        self.word_count = np.bincount(win)
        self.word_first = np.cumsum(self.word_count) - self.word_count

    def pick(self, some: np.ndarray) -> tuple[Averages, Averages]:
        words = ragged(self.words, self.word_first[some], self.word_count[some])
        own, words = np.unique(words, return_inverse=True)
        n = self.gram_count[own]
        grams = ragged(self.grams, self.gram_first[own], n)
        return (Averages(np.repeat(np.arange(len(own)), n), grams, len(own)),
                Averages(np.repeat(np.arange(len(some)), self.word_count[some]), words, len(some)))


class Model:
    """n-gram embeddings and a linear softmax with Adam moments."""

    def __init__(self, emb, soft, bias):
        self.emb, self.soft, self.bias = (x.astype(np.float32) for x in (emb, soft, bias))
        self.moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.emb, self.soft, self.bias)]
        self.turn = 0

    def forward(self, words: Averages, wins: Averages) -> tuple[np.ndarray, np.ndarray]:
        x = wins.forward(words.forward(self.emb))
        z = x @ self.soft + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return x, p / p.sum(axis=1, keepdims=True)

    def predict(self, words: Averages, wins: Averages) -> np.ndarray:
        return self.forward(words, wins)[1][:, 1]

    def step(self, words: Averages, wins: Averages, y: np.ndarray, clean: float, toxic: float) -> None:
        self.turn += 1
        x, grad = self.forward(words, wins)
        grad[np.arange(len(y)), y] -= 1
        grad = (grad * np.where(y == 1, toxic, clean)[:, None]).astype(np.float32)
        back = words.backward(wins.backward(grad @ self.soft.T, words.n_rows), len(self.emb))
        grads = [back, x.T @ grad, grad.sum(axis=0)]
        for param, g, (m, v) in zip((self.emb, self.soft, self.bias), grads, self.moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            param -= RATE * (m / (1 - 0.9 ** self.turn)) / (np.sqrt(v / (1 - 0.99 ** self.turn)) + 1e-8)


def word_scores(hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Average n-gram score of each word, computed once for each distinct word."""
    values, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    bucket, owner = subwords(data, starts[at], ends[at])
    return (np.bincount(owner, weights=table[bucket], minlength=len(values)) / np.bincount(owner, minlength=len(values)))[which]


def _score_pass(table: np.ndarray, bias: float):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = V.text_buffers(batch.column(1))
            logit = np.full(batch.num_rows, bias)
            for i, j in V.row_blocks(offsets):
                w = without_repeats(V.words_of(data, offsets[i:j + 1], V.NOT_ALNUM))
                if not len(w.hashes):
                    continue
                start = w.starts + (offsets[i:j + 1] - offsets[i])[w.row_of()]
                s = word_scores(w.hashes, data[offsets[i]:offsets[j]], start, start + w.ends - w.starts, table)
                of, rows = windows(w)
                z = np.bincount(of, weights=s) / np.bincount(of) + bias
                full = np.flatnonzero(np.diff(w.offsets))
                logit[i + full] = np.maximum.reduceat(z, np.searchsorted(rows, full))
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])
    return run


@V.frugal
def _train_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if rows is None or not rows.num_rows:
        model = train([], np.zeros(0, dtype=np.int64))
    else:
        rows = rows.sort_by("doc_id")
        model = train([t or "" for t in rows.column("text").to_pylist()], rows.column("toxic").to_numpy().astype(np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_rows(labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, toxic): at most ``limit`` ids of each class outside the held-out fold, in
    order of their hash. Null ids and labels, and ids with different labels, are left out."""
    rows = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("long").alias("toxic")).dropna()
            .filter("toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("hi"))
            .filter("toxic = hi").drop("hi").filter(~held_out(F.col("doc_id"))))
    pick = lambda v: rows.filter(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return pick(0).unionByName(pick(1))


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """The model of ``train`` over a bounded sample, trained in one task; of rows with one id one text is used."""
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .join(F.broadcast(training_rows(labels, limit)), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    # the sample is bounded, so one task can hold it
    model = rows.select("doc_id", "toxic", "text").repartition(1).mapInArrow(_train_pass, "model binary").first()
    return pickle.loads(model[0]) if model else train([], np.zeros(0, dtype=np.int64))


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT, limit: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Null, empty and blank texts have the score of the bias alone. Ids that are null
    count as the empty string in ``held_out``; repeated rows are scored each. Without labels of both
    classes all scores are one constant. Other columns are ignored; an empty table gives none.
    """
    table, bias = fit(docs, labels, limit)
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_score_pass(table, bias), "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))

"""Quality classifier by importance resampling.

Two hashed n-gram models, one of labelled good texts (target) and one of all
texts (raw), give every document a log weight: the sum over its n-grams of the
log ratio of the two models. Adding Gumbel noise and taking the k largest keys
samples k documents without replacement in proportion to their weights.

n-grams: words and word pairs, and the shapes of words (letter case, punctuation,
whether the word repeats the one before) and of word pairs, which also speak
about words never seen in the target.

The raw model counts every document. Labels are read from a sample of at most
MAX_LABELS rows (by hash of the id): half fit the target model, half calibrate
k, the number of documents whose key reaches the best cut between good and bad.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.llm import textvec as V
from retailcast.session import materialize

BUCKETS = 1 << 16
#: Columns added to scored rows.
LOG_WEIGHT, KEY, UNIFORM = "_dsir_log_weight", "_dsir_gumbel_key", "_dsir_uniform"
#: Labelled rows used at most; a fixed bound of the fit.
MAX_LABELS = 20_000
#: Pseudo-count of both models: what a bucket must be expected for its count to speak.
PRIOR = 5.0
#: Production values of two parameters of ``resample``, see there.
LENGTH: int | None = 100
MARGIN = float(np.log(2))
#: Keys sorted on the driver at most when the k-th is looked for.
FINE, BINS = 10_000, 1_000


def shape_codes(data: np.ndarray, w: V.Words, starts: np.ndarray) -> np.ndarray:
    """A hash of each word's shape; ``starts``: byte positions in ``data``."""
    ends = starts + (w.ends - w.starts)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    other = (data < 128) & ~upper & ~lower & ~digit
    count = lambda m, most: np.minimum((c := np.concatenate([[0], np.cumsum(m)]))[ends] - c[starts], most)
    last = np.where(other[ends - 1], data[ends - 1], 0).astype(np.int64)
    row = w.row_of()
    again = np.zeros(len(starts), dtype=np.int64)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (row[1:] == row[:-1])
    code = ((((count(upper, 2) * 2 + count(lower, 1)) * 2 + count(digit, 1)) * 4 + count(other, 3)) * 128 + last) * 2 + again
    return V.mix(code.astype(V.U) + V.U(7))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(buckets, rows, number of rows) of all n-grams of the rows."""
    w = V.words_of(data, offsets)
    row = w.row_of()
    own = data[offsets[0]:offsets[-1]]
    shape = shape_codes(own, w, w.starts + (offsets - offsets[0])[row]) if len(row) else np.zeros(0, V.U)
    out, rows = [], []
    with np.errstate(over="ignore"):
        for salt, h in ((1, w.hashes), (2, shape)):
            out.append(V.mix(h + V.U(salt)))
            rows.append(row)
            if len(h) > 1:
                same = row[1:] == row[:-1]
                out.append(V.mix(h[:-1] * V.GRAM_CODE[2] + h[1:] * V.GRAM_CODE[3] + V.U(salt))[same])
                rows.append(row[1:][same])
    return (np.concatenate(out) >> V.U(48)).astype(np.int64), np.concatenate(rows), w.rows


@V.frugal
def _count_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(good, text) -> a task's n-gram counts of all texts and of the good ones."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        good = batch.column(0).fill_null(False).to_numpy(zero_copy_only=False)
        data, offsets = V.text_buffers(batch.column(1))
        for i, j in V.row_blocks(offsets):
            bucket, row, _ = features(data, offsets[i:j + 1])
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[i:j][row]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def label_sample(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", limit: int = MAX_LABELS) -> DataFrame:
    """(doc_id, good, fit): at most ``limit`` labelled ids in order of their hash;
    an id with different labels counts as bad, null ids and labels are left out."""
    rows = (labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) == 1).alias("good")).dropna()
            .groupBy("doc_id").agg(F.min("good").alias("good")))
    h = F.xxhash64("doc_id", F.lit("sample"))
    return rows.orderBy(h, "doc_id").limit(limit).select("doc_id", "good", (F.pmod(h, F.lit(2)) == 0).alias("fit"))


def fit(docs: DataFrame, sample: DataFrame, margin: float = MARGIN) -> np.ndarray:
    """Log ratio of the target and raw models by bucket; those below ``margin`` count as 0."""
    flagged = (docs.select("doc_id", "text").join(F.broadcast(sample.filter("fit and good").select("doc_id", "good")), "doc_id", "left")
               .select("good", "text"))
    rows = (flagged.mapInArrow(_count_pass, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows.column("bucket").to_numpy()] = rows.column("raw").to_numpy()
    target[rows.column("bucket").to_numpy()] = rows.column("target").to_numpy()
    if not target.any():                                # nothing labelled good: no document is preferred
        return np.zeros(BUCKETS)
    # the target's count against the one expected at the raw rate; PRIOR keeps rare n-grams near 1
    ratio = np.log(target + PRIOR) - np.log(raw * (target.sum() / raw.sum()) + PRIOR)
    return np.where(np.abs(ratio) < margin, 0.0, ratio)


def _score_pass(ratio: np.ndarray, text_col: str, uniform_col: str, length: int | None):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = V.text_buffers(batch.column(text_col))
            weight = np.zeros(batch.num_rows)
            for i, j in V.row_blocks(offsets):
                bucket, row, n = features(data, offsets[i:j + 1])
                count = np.bincount(row, minlength=n)
                weight[i:j] = np.bincount(row, weights=ratio[bucket], minlength=n)
                if length is not None:
                    weight[i:j] *= length / np.maximum(count, length)
            u = batch.column(uniform_col).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.drop_columns([uniform_col]).columns, pa.array(weight), pa.array(weight - np.log(-np.log(u)))],
                [*(c for c in batch.schema.names if c != uniform_col), LOG_WEIGHT, KEY])
    return run


def score(docs: DataFrame, ratio: np.ndarray, seed: int, text_col: str = "text", id_col: str = "doc_id", length: int | None = LENGTH) -> DataFrame:
    """``docs`` with LOG_WEIGHT and KEY; the noise is a hash of id, text and seed."""
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.lit(seed)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    schema = T.StructType([*docs.schema.fields, T.StructField(LOG_WEIGHT, T.DoubleType()), T.StructField(KEY, T.DoubleType())])
    return docs.withColumn(UNIFORM, u).mapInArrow(_score_pass(ratio, text_col, UNIFORM, length), schema)


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest KEY, by histograms that narrow down on it; -inf for k past the end."""
    lo, hi, n = keys.agg(F.min(KEY), F.max(KEY), F.count(KEY)).first()
    if k <= 0 or not n:
        return float("inf")
    if k > n:
        return float("-inf")
    left = k
    while True:
        inside = keys.filter(F.col(KEY).between(lo, hi))
        width = (hi - lo) / BINS
        if width <= 0 or lo + width == lo or inside.count() <= FINE:
            if lo == hi:
                return lo
            return [r[0] for r in inside.select(KEY).orderBy(F.desc(KEY)).limit(left).collect()][-1] if inside.count() <= FINE else lo
        bins = sorted(inside.groupBy(F.least(F.floor((F.col(KEY) - lo) / width), F.lit(BINS - 1)).alias("b"))
                      .agg(F.count("*").alias("c"), F.min(KEY).alias("lo"), F.max(KEY).alias("hi")).collect(), key=lambda r: -r.b)
        for r in bins:
            if left <= r.c:
                lo, hi = r.lo, r.hi
                break
            left -= r.c


def calibrated_count(scored: DataFrame, sample: DataFrame) -> int:
    """k: the documents whose key reaches the cut that tells the held-back labels apart
    best (halfway between the two keys at it). Without labels of both kinds, all."""
    rows = (scored.select("doc_id", KEY).join(F.broadcast(sample.filter("not fit")), "doc_id")
            .select(KEY, "good").toArrow())
    good, key = rows.column("good").to_numpy(), rows.column(KEY).to_numpy()
    if not good.any() or good.all():
        return scored.count()
    order = np.argsort(key, kind="stable")
    good, key = good[order], key[order]
    # cut before position i: bad ones below it and good ones from it on are right
    right = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum() + (good.sum() - np.concatenate([[0], np.cumsum(good)])) / good.sum()
    i = int(np.argmax(right))
    cut = float("-inf") if i == 0 else (key[i - 1] + key[i]) / 2 if i < len(key) else float("inf")
    return scored.filter(F.col(KEY) >= cut).count()


def resample(docs: DataFrame, labels: DataFrame, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", k: int | None = None, length: int | None = LENGTH, margin: float = MARGIN) -> tuple[DataFrame, float]:
    """(scored rows, least key that is sampled): a row is sampled if its key reaches it.

    ``k`` defaults to ``calibrated_count``. Every row takes part, those with null
    ids too. Null and empty texts have log weight 0. Equal rows have one key and share
    their fate (ties at the k-th key are all in). An empty table gives none.

    ``length`` bends the weight of a text of more n-grams to that of as many (None: the sum over
    all n-grams, whatever the length); n-grams with a log ratio below ``margin`` say nothing (0: all
    speak). Their production values stand for the sampling error of the target model, whose share
    of a language or topic is uncertain and which long texts would add up.
    """
    sample = materialize(label_sample(labels, id_col, label_col), "label_sample")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = score(docs, fit(texts, sample, margin), seed, text_col, id_col, length)
    keys = materialize(scored.select(F.col(id_col).cast("long").alias("doc_id"), KEY), "keys")
    return scored, kth_largest(keys, calibrated_count(keys, sample) if k is None else k)


def quality_filter(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, all columns."""
    scored, least = resample(docs, labels, **options)
    return scored.filter(F.col(KEY) >= least).drop(LOG_WEIGHT, KEY).select(*docs.columns)

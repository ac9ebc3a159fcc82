"""Benchmark decontamination by SimHash over item-sized windows.

For every item, the windows of a document with as many words as the item are
compared with it: 64-bit SimHash fingerprints over weighted 5-word shingles, a
multi-index over BLOCKS blocks (fingerprints within RADIUS differ by at most
RADIUS // BLOCKS bits in some block, and every block value of that ball is
listed), then the exact similarity of the weighted shingles (sum of minima over
sum of maxima of the counts).

A window without a shingle of an item has similarity 0, so only windows aligned
to a shared shingle are fingerprinted; hashing the shingles is one vectorised
pass and the documents are never shuffled. At similarity 0.75 fingerprints
differ in about 11 bits (deviation 3); RADIUS is over five deviations away.

Items are taken in blocks of at most ITEM_BLOCK, each a pass of its own, so
what is broadcast doesn't grow with the benchmark.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm import textvec as V

K, THRESHOLD = 5, 0.75
BITS, BLOCKS, RADIUS = 64, 8, 28
ITEM_BLOCK = 5_000
#: Masks that reach every block value within RADIUS // BLOCKS bits.
BALL = [sum(1 << i for i in c) for d in range(RADIUS // BLOCKS + 1) for c in combinations(range(BITS // BLOCKS), d)]


def simhash(grams: np.ndarray) -> np.ndarray:
    """Fingerprints of the rows of a (windows, shingles) matrix of hashes; a
    shingle that occurs twice weighs twice."""
    votes = np.zeros((len(grams), BITS), dtype=np.int32)
    for column in grams.T:
        votes += np.unpackbits(V.mix(column).view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * votes > grams.shape[1], axis=1).view(np.uint64).ravel()


def between(found: set, size: int) -> list[tuple[int, int]]:
    """(row, first word) of aligned windows and of those between two that overlap."""
    out, last = [], (-1, 0)
    for r, s in sorted(found):
        out += [(r, k) for k in range(last[1] + 1 if last[0] == r and s - last[1] < size else s, s + 1)]
        last = r, s
    return out


def similarity(a: Counter, b: Counter) -> float:
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


class Items:
    """A block of benchmark items: shingles to align windows, and the multi-index by item length."""

    def __init__(self, rows: list[tuple[int, str]]):
        w = V.words_of(*V.text_buffers(pa.array([t for _, t in rows], pa.string())))
        grams, row, at = V.gram_hashes(w, K)
        self.ids = [i for i, _ in rows]
        self.words = np.diff(w.offsets)
        bounds = np.searchsorted(row, np.arange(len(rows) + 1))
        own = [grams[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.weights = [Counter(g.tolist()) for g in own]
        order = np.argsort(grams, kind="stable")
        self.set = V.HashSet(grams)
        self.first = np.append(np.searchsorted(grams[order], self.set.values), len(grams))
        self.gram_item, self.gram_at = row[order], (at - w.offsets[:-1][row])[order]
        self.prints = np.array([simhash(g[None, :])[0] if len(g) else 0 for g in own], dtype=np.uint64)
        self.index: dict = defaultdict(list)
        self.short = sorted({int(n) for n in self.words if 0 < n < K})
        self.short_items: dict = defaultdict(list)
        for i, g in enumerate(own):
            if 0 < self.words[i] < K:
                self.short_items[int(g[0])].append(i)
        for i, p in enumerate(self.prints):
            for b in range(BLOCKS):
                value = int(p >> np.uint64(8 * b)) & 255
                for m in BALL:
                    self.index[int(self.words[i]), b, value ^ m].append(i)

    def near(self, size: int, fingerprint: np.uint64) -> list[int]:
        """Items of ``size`` words within RADIUS of a fingerprint."""
        found = {i for b in range(BLOCKS) for i in self.index.get((size, b, int(fingerprint >> np.uint64(8 * b)) & 255), ())}
        return [i for i in sorted(found) if (int(self.prints[i]) ^ int(fingerprint)).bit_count() <= RADIUS]

    def match(self, w: V.Words) -> Iterator[tuple[int, int, float, int]]:
        """(row, item, similarity, first word) of the best window of each matching row and item."""
        grams, row, at = V.gram_hashes(w, K)
        pos, which = self.set.index(grams)
        n_grams = np.bincount(row, minlength=w.rows)
        gram_off = np.concatenate([[0], np.cumsum(n_grams)])
        n_words = np.diff(w.offsets)
        windows: dict[int, set] = defaultdict(set)
        for p, g in zip(pos, which, strict=True):
            r = int(row[p])
            start = int(at[p] - w.offsets[r])
            for k in range(self.first[g], self.first[g + 1]):
                size = int(self.words[self.gram_item[k]])
                windows[size].add((r, min(max(start - int(self.gram_at[k]), 0), max(int(n_words[r]) - size, 0))))
        best: dict = {}
        for size, found in windows.items():
            for r, s in between(found, size):
                n = min(size, int(n_words[r]))
                own = grams[gram_off[r] + s: gram_off[r] + s + max(n - K + 1, 1)]
                for i in self.near(size, simhash(own[None, :])[0]):
                    score = similarity(Counter(own.tolist()), self.weights[i])
                    if score >= THRESHOLD and score > best.get((r, i), (0.0,))[0]:
                        best[r, i] = score, s
        for size in self.short:         # a window below K words is one shingle: equal or not
            grams, row, at = V.gram_hashes(w, size)
            known = np.array([h for h, i in self.short_items.items() if self.words[i[0]] == size], dtype=V.U)
            for p in np.flatnonzero(np.isin(grams, known)):
                for i in self.short_items[int(grams[p])]:
                    best.setdefault((int(row[p]), i), (1.0, int(at[p] - w.offsets[row[p]])))
        for (r, i), (score, s) in sorted(best.items()):
            yield r, i, score, s


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    rows = items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).filter(
        F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).distinct().toLocalIterator()
    block: list = []
    for r in rows:
        block.append((r[0], r[1]))
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


HITS = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def _hit_pass(rows: list):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows)
        for batch in batches:
            out: list = []
            ids = batch.column(0)
            for first, w in V.word_blocks(batch.column(1)):
                out += [(ids[first + r].as_py(), items.ids[i], score, s, int(items.words[i])) for r, i, score, s in items.match(w)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                list(zip(*out, strict=True)) or [[]] * 5, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "item_id", "similarity", "first_word", "n_words"])
    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): documents that hold an item.

    Per document and item the best of the windows in which a shared shingle stands
    where the item has it and of those between them (the first on ties). A text
    shorter than an item is compared whole. Items and texts without words, null ones, and items
    without an id match nothing; documents with a null id are reported with it;
    repeated rows are reported each. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], HITS)
    for rows in item_blocks(items, item_id, item_text):
        out = out.unionByName(docs.mapInArrow(_hit_pass(rows), HITS))
    return out


def _clean_pass(rows: list, text_col: str):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for first, w in V.word_blocks(batch.column(text_col)):
                for r, *_ in items.match(w):
                    keep[first + r] = False
            yield batch.filter(pa.array(keep))
    return run


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item; all columns stay."""
    for rows in item_blocks(items, item_id, item_text):
        docs = docs.mapInArrow(_clean_pass(rows, text_col), docs.schema)
    return docs

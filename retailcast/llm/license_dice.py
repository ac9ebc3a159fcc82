"""Licence scan: normalised text against licence templates by the Dice
coefficient over word bigrams.

Normalised words are runs of letters and digits, A-Z lower-cased; a point between
digits stays, so 2.0 is one word. White space, newlines and other punctuation don't
count. A template is compared with the windows of a text that have as many words
and are aligned to a shared bigram. Sizes prune first: a window of a bigrams and a
template of b reach Dice t only if min(a, b) >= t / (2 - t) * max(a, b), and only if
t / 2 * (a + b) bigrams of the window are the template's. A window counts if the
name and version words of its licence are in it; of windows that overlap, the one
with the highest Dice wins.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm import textvec as V
from retailcast.llm.license_texts import Template, templates

THRESHOLD = 0.8
#: The byte that stands for a point between digits; no UTF-8 text has it.
POINT = 0xFF


def normalised(data: np.ndarray) -> np.ndarray:
    """``data`` with each point between two digits as a byte of a word."""
    digit = (data >= 48) & (data <= 57)
    inner = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        inner[1:-1] = (data[1:-1] == 46) & digit[:-2] & digit[2:]
    return np.where(inner, np.uint8(POINT), data)


def word_hashes(text: str) -> list[int]:
    data, offsets = V.text_buffers(pa.array([text]))
    return V.words_of(normalised(data), offsets, V.NOT_ALNUM).hashes.tolist()


def bigrams(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return V.mix(h[:-1] * V.GRAM_CODE[0] + h[1:] * V.GRAM_CODE[1]) if len(h) > 1 else np.zeros(0, V.U)


def holds(words: list[int], part: list[int]) -> bool:
    n = len(part)
    return any(words[i] == part[0] and words[i:i + n] == part for i in range(len(words) - n + 1))


class Matcher:
    def __init__(self, table: list[Template], threshold: float):
        self.table, self.t = table, threshold
        self.bags, self.must, self.never, self.anchors = [], [], [], defaultdict(set)
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, x in enumerate(table):
            grams = bigrams(np.array(word_hashes(x.text), dtype=V.U)).tolist()
            self.bags.append(Counter(grams))
            for o, g in enumerate(grams):
                self.postings[g].append((k, o))
            self.must.append([[word_hashes(p) for p in any_of] for any_of in x.must])
            self.never.append([word_hashes(p) for p in x.never])
            for p in self.must[-1][0]:                  # a text without its first words can't be this licence
                self.anchors[p[0]].add(k)
        self.size = [sum(b.values()) for b in self.bags]
        self.known = V.HashSet(np.array(list(self.postings), dtype=V.U))
        self.anchor_set = V.HashSet(np.array(list(self.anchors), dtype=V.U))

    def windows(self, words: np.ndarray) -> list[tuple[float, int, int, int]]:
        """(Dice, first word, words, template) of the windows of a text that count."""
        at, which = self.anchor_set.index(words)
        able = set().union(*(self.anchors[int(self.anchor_set.values[w])] for w in set(which.tolist()))) if len(at) else set()
        if not able:
            return []
        grams = bigrams(words)
        pos, which = self.known.index(grams)
        starts, hits = defaultdict(set), defaultdict(list)
        for p, w in zip(pos.tolist(), which.tolist(), strict=True):
            for k, o in self.postings[int(self.known.values[w])]:
                if k in able:
                    if not hits[k] or hits[k][-1] != p:
                        hits[k].append(p)
                    starts[k].add(p - o)
        out, n_words = [], len(words)
        for k, own in starts.items():
            b = self.size[k]
            a = min(b, n_words - 1)
            if min(a, b) * (2 - self.t) < self.t * max(a, b) or len(hits[k]) * 2 < self.t * (a + b) - 1e-9:
                continue
            for s in sorted({min(max(s, 0), n_words - 1 - a) for s in own}):
                if (bisect_left(hits[k], s + a) - bisect_left(hits[k], s)) * 2 < self.t * (a + b) - 1e-9:
                    continue
                common = sum((Counter(grams[s:s + a].tolist()) & self.bags[k]).values())
                score = 2 * common / (a + b)
                if score >= self.t:
                    held = words[s:s + a + 1].tolist()
                    if all(any(holds(held, p) for p in any_of) for any_of in self.must[k]) and not any(holds(held, p) for p in self.never[k]):
                        out.append((score, s, a + 1, k))
        return out

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, str, float, int, int]]:
        """(row, licence, best score, first word, words) of each row's licences."""
        w = V.words_of(normalised(data[offsets[0]:offsets[-1]]), offsets - offsets[0], V.NOT_ALNUM)
        some = np.unique(w.row_of()[self.anchor_set.index(w.hashes)[0]])
        for r in some.tolist():
            taken: list[tuple[int, int, str]] = []
            best: dict = {}
            for score, s, n, k in sorted(self.windows(w.hashes[w.offsets[r]:w.offsets[r + 1]]), key=lambda x: (-x[0], -x[2], x[1], self.table[x[3]].license)):
                name = self.table[k].license
                if any(s < e and f < s + n and other != name for f, e, other in taken):
                    continue
                taken.append((s, s + n, name))
                best.setdefault(name, (score, s, n))
            for name, (score, s, n) in sorted(best.items()):
                yield r, name, score, s, n


HITS = "doc_id long, license string, dice double, first_word long, n_words long"


def _pass(table: list[Template], threshold: float):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(table, threshold)
        for batch in batches:
            out: list = []
            data, offsets = V.text_buffers(batch.column(1))
            for i, j in V.row_blocks(offsets):
                out += [(batch.column(0)[i + r].as_py(), *x) for r, *x in matcher.scan(data, offsets[i:j + 1])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                list(zip(*out, strict=True)) or [[]] * 5, (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "license", "dice", "first_word", "n_words"])
    return run


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 table: list[Template] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, first_word, n_words): one row per document and
    licence found, with its best window (ties: the longer, then the first).

    A text shorter than a template is compared whole. Of overlapping windows of
    different licences the better one stays. A licence of another version than the templates' has
    no row. Null, empty and one-word texts have no bigram and match nothing. Rows with a
    null id are reported with it, repeated rows each; an empty table gives none; other columns
    are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_pass(table or templates(), threshold), HITS)

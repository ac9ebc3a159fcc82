"""Vectorised word and n-gram hashing over Arrow text columns (numpy, no per-word Python).

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z
lower-cased; its hash is a polynomial over random 64-bit byte codes, mixed at
the end, so equal words have equal hashes in every task. Two different
words, n-grams or sets collide with probability about 2^-64 per pair.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64


def frugal(task):
    """A task function that gives freed memory back to the system at its end: Python
    workers stay for later tasks, and their allocators would keep it."""
    @functools.wraps(task)
    def run(*args):
        try:
            yield from task(*args)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # the C library's, where it has it
            if trim:
                trim(0)
    return run


_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U) | U(1)
BYTE_CODE[65:91] = BYTE_CODE[97:123]
BASE = U(0x9E3779B97F4A7C15)
BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
GRAM_CODE = _rng.integers(1, 2**63, 16, dtype=np.int64).astype(U) | U(1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Separators of normalised words: every ASCII byte but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Bytes worked on at a time; a longer single text is cut only between words.
BLOCK_BYTES = 1 << 20
_pow = np.ones(1, dtype=U), np.ones(1, dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = np.asarray(x, dtype=U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow
    if len(_pow[0]) < n:
        size = max(n, min(BLOCK_BYTES, 2 * n))
        with np.errstate(over="ignore"):
            fwd = np.cumprod(np.concatenate([[U(1)], np.full(size, BASE, dtype=U)]), dtype=U)
            inv = np.cumprod(np.concatenate([[U(1)], np.full(size, BASE_INV, dtype=U)]), dtype=U)
        _pow = fwd, inv
    return _pow


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span [start, end) of ``data`` (lower-cased A-Z)."""
    if not len(starts):
        return np.zeros(0, dtype=U)
    fwd, inv = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([[U(0)], np.cumsum(BYTE_CODE[data] * fwd[: len(data)], dtype=U)])
        return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(U))


@dataclass
class Words:
    """Words of consecutive rows: ``offsets[i]:offsets[i+1]`` are row i's words;
    ``starts`` / ``ends`` are byte positions within the row's text."""
    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.offsets))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def _block_words(data: np.ndarray, row_starts: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word starts, ends and hashes in ``data``; a word never crosses a row start."""
    solid = ~blank[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cut = row_starts[(row_starts > 0) & (row_starts < len(data))]
    first[cut] = solid[cut]
    last[cut - 1] = solid[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, span_hashes(data, starts, ends)


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    i, rows = 0, len(offsets) - 1
    while i < rows:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), rows)
        yield i, j
        i = j


def words_of(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> Words:
    """Words of the rows with the given byte offsets into ``data``; ``blank`` marks separating bytes."""
    parts, lo, hi = [], int(offsets[0]), int(offsets[-1])
    if hi - lo > 2 * BLOCK_BYTES and len(offsets) == 2:      # one long text: blocks cut at white space
        at = lo
        while at < hi:
            end = min(at + BLOCK_BYTES, hi)
            while end < hi and not blank[data[end]]:
                end += 1
            s, e, h = _block_words(data[at:end], np.zeros(0, np.int64), blank)
            parts.append((s + (at - lo), e + (at - lo), h))
            at = end
        s, e, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        return Words(h, np.array([0, len(h)]), s, e)
    s, e, h = _block_words(data[lo:hi], offsets - lo, blank)
    counts = np.searchsorted(s, offsets - lo)
    base = np.repeat(offsets[:-1] - lo, np.diff(counts))
    return Words(h, counts, s - base, e - base)


def word_blocks(column: pa.Array, blank: np.ndarray = SPACE) -> Iterator[tuple[int, Words]]:
    """(first row, words) over bounded blocks of rows of a text column."""
    data, offsets = text_buffers(column)
    for i, j in row_blocks(offsets):
        yield i, words_of(data, offsets[i:j + 1], blank)


def gram_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k-word shingles as (hash, row, first word index). A row with 1 to k-1
    words has its whole word sequence as its one shingle, an empty row none."""
    n = np.diff(w.offsets)
    row = w.row_of()
    h = np.zeros(len(w.hashes), dtype=U)
    with np.errstate(over="ignore"):
        for j in range(k):
            part = w.hashes[j:] * GRAM_CODE[j]
            h[: len(part)] += part
        whole = np.arange(len(row)) + k <= w.offsets[1:][row]
        grams, rows, at = mix(h[whole] + U(k)), row[whole], np.flatnonzero(whole)
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            extra = np.empty(len(short), dtype=U)
            for i, r in enumerate(short):
                own = w.hashes[w.offsets[r]: w.offsets[r + 1]]
                extra[i] = mix(np.sum(own * GRAM_CODE[: len(own)], dtype=U) + U(len(own)))
            grams, rows, at = (np.concatenate([grams, extra]), np.concatenate([rows, short]),
                               np.concatenate([at, w.offsets[short]]))
            order = np.argsort(rows, kind="stable")
            grams, rows, at = grams[order], rows[order], at[order]
    return grams, rows, at


def distinct_per_row(grams: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row: (hashes, offsets)."""
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    parts = []
    sizes = np.zeros(n_rows, dtype=np.int64)
    for r in range(n_rows):
        if bounds[r + 1] > bounds[r]:
            own = np.unique(grams[bounds[r]: bounds[r + 1]])
            parts.append(own)
            sizes[r] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, U)), np.concatenate([[0], np.cumsum(sizes)])


class HashSet:
    """Membership of 64-bit hashes in a bounded set: a bit table first, then binary search."""

    def __init__(self, values: np.ndarray, bits: int = 22):
        self.values = np.unique(np.asarray(values, dtype=U))
        self.shift = U(64 - bits)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[(self.values >> self.shift).astype(np.int64)] = True

    def index(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in x of members, their indices in ``values``)."""
        maybe = np.flatnonzero(self.table[(x >> self.shift).astype(np.int64)]) if len(self.values) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.values, x[maybe]), max(len(self.values) - 1, 0))
        hit = self.values[at] == x[maybe] if len(maybe) else np.zeros(0, bool)
        return maybe[hit], at[hit]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def key_runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal integer ``keys`` as one table each; the
    batches come from a partition sorted by ``keys``. One group is held at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]])
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            part = pa.Table.from_batches([batch.slice(a, b - a)])
            if i == 0 and held and any(held[-1].column(k)[-1] != part.column(k)[0] for k in keys):
                yield pa.concat_tables(held)
                held = []
            elif i:
                yield pa.concat_tables(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held)


#: Bits of the prefilter of ids; it lets through every listed id and, beyond some millions, others too.
ID_BITS = 24


def id_bitmap(ids) -> np.ndarray:
    """A fixed-size bit table (2 MB) of the hashes of a one-column integer DataFrame.

    It only spares work ahead of an exact join: members always pass it.
    """
    from pyspark.sql import functions as F
    h = F.xxhash64(ids[ids.columns[0]].cast("long"))
    slot = F.shiftrightunsigned(h, 64 - ID_BITS)
    rows = (ids.select(slot.alias("s")).filter("s is not null")
            .groupBy(F.shiftright("s", 6).cast("int").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).toArrow())
    words = np.zeros(1 << (ID_BITS - 6), dtype=np.int64)
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return words


def in_bitmap(words: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """``slot``: the top ID_BITS of xxhash64 of the id, computed by Spark."""
    return (words[slot >> 6] >> (slot & 63)) & 1 == 1

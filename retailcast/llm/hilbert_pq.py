"""Product quantisation of integer vectors over Hilbert-sorted flat blocks.

Each of the four part positions is a table of points of its own. Its points are
sorted along a Hilbert curve and cut into flat blocks, stored once with their
min/max box, component sums and points. A round ships the codebooks (a fixed size)
to every task. The least and greatest squared distance of a block's box to each
entry leave a shortlist: entries whose least distance exceeds another's greatest
can't be nearest to any point of the block. One entry left takes the whole block
by its stored sums; otherwise an exact integer kernel evaluates points times
shortlist. Tasks send a sum per codebook entry, Spark adds them up, and only the
new codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm import intvec as V
from retailcast.llm.textvec import frugal
from retailcast.session import materialize

SCALE = 1024.0
PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK = 128
BLOCKS = "part int, uids binary, points binary, low binary, high binary, sums array<double>"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells of ``bits`` bits a dimension, at most 63
    bits in all (Skilling's transposed form: exchange and invert low bits, then Gray decode)."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(d):
            invert = (x[i] & q) != 0
            swap = np.where(invert, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(invert, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _points(d: int, low: list[float], high: list[float]):
    """(part, key, uid, point) of every usable vector of length ``d``; the key's cells span each part's range."""
    w = d // PARTS
    used = min(w, 31)                                   # the curve orders by the first components
    bits = max(1, min(8, 62 // max(used, 1)))

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in V.matrices(batch.column(1), SCALE):
                if x.shape[1] != d:
                    continue
                uid = batch.column(0).take(pa.array(rows))
                for p in range(PARTS):
                    part = np.ascontiguousarray(x[:, p * w:(p + 1) * w])
                    wide = max(high[p] - low[p], 1.0)
                    cells = np.clip((part[:, :used] / wide - low[p] / wide) * (1 << bits), 0, (1 << bits) - 1)
                    key = hilbert(cells, bits) if used else np.zeros(len(rows), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), p, dtype=np.int32)), pa.array(key), uid, pa.array([r.tobytes() for r in _stored(part)], pa.binary())], ["part", "key", "uid", "point"])
    return run


def _stored(x: np.ndarray) -> np.ndarray:
    """Integers in 4 bytes where all fit, else doubles; the size tells them apart."""
    return x.astype("<i4") if np.abs(x).max(initial=0) < 2**31 else x.astype("<f8")


def _read(data: bytes, n: int, w: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if len(data) == 4 * n * w else "<f8").reshape(n, w).astype(np.float64)


def _pack(w: int):
    """Consecutive points of a sorted partition as flat blocks."""
    def block(part: int, uids: list[np.ndarray], points: list[np.ndarray]) -> list:
        x = np.concatenate(points)
        return [part, np.concatenate(uids).tobytes(), _stored(x).tobytes(), x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), x.sum(axis=0)]

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, uids, points, held, out = -1, [], [], 0, []

        def batch_of(rows: list) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:5]], pa.array(cols[5], pa.list_(pa.float64()))],
                                              ["part", "uids", "points", "low", "high", "sums"])

        for batch in batches:
            parts, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            data = [_read(p.as_py(), 1, w) for p in batch.column(3)]
            data = np.concatenate(data) if data else np.zeros((0, w))
            at = 0
            while at < batch.num_rows:
                if held and (parts[at] != part or held == BLOCK):
                    out.append(block(part, uids, points))
                    uids, points, held = [], [], 0
                    if len(out) == 64:
                        yield batch_of(out)
                        out = []
                part = int(parts[at])
                end = min(at + BLOCK - held, int(np.searchsorted(parts, part, side="right")))
                uids.append(own[at:end])
                points.append(data[at:end])
                held += end - at
                at = end
        if held:
            out.append(block(part, uids, points))
        if out:
            yield batch_of(out)
    return run


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, exact squared distance); ties go to the lower index."""
    a, b = V.largest(x, entries)
    most = max(x.shape[1], 1) * (a + b) ** 2
    if most < V.EXACT:
        d = (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None, :]
    elif most < V.LONG:
        x, entries = x.astype(np.int64), entries.astype(np.int64)
        d = np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)
    else:
        x, entries = V.whole(x), V.whole(entries)
        d = np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Entries that can be the nearest of a point of the box, ascending."""
    under, over = low - entries, entries - high
    least = (np.maximum(np.maximum(under, over), 0) ** 2).sum(axis=1)
    most = (np.maximum(np.abs(entries - low), np.abs(entries - high)) ** 2).sum(axis=1)
    return np.flatnonzero(least <= most.min() * (1 + 1e-12))


def _each(codebooks: np.ndarray, batches: Iterator[pa.RecordBatch]):
    """(part, points held, point data, box, sums, shortlist) of each block."""
    for batch in batches:
        for r in range(batch.num_rows):
            part, uids, points, low, high, sums = (batch.column(i)[r].as_py() for i in range(6))
            box = np.frombuffer(low), np.frombuffer(high)
            yield part, len(uids) // 8, points, box, sums, shortlist(*box, codebooks[part])


class Sums:
    """Exact sums and counts per codebook entry: doubles, added to Python integers before they could round."""

    def __init__(self, shape: tuple[int, int, int]):
        self.count, self.whole, self.part, self.room = np.zeros(shape[:2], np.int64), np.zeros(shape, object), np.zeros(shape), V.EXACT

    def add(self, part: int, entries: np.ndarray, counts: np.ndarray, sums: np.ndarray, most: float) -> None:
        """``most``: a bound of the absolute values of ``sums``."""
        self.count[part, entries] += counts
        if most >= V.EXACT:
            self.whole[part, entries] += V.whole(sums)
            return
        if most >= self.room:
            self.flush()
        self.room -= most
        self.part[part, entries] += sums

    def flush(self) -> None:
        self.whole += V.whole(self.part)
        self.part[:] = 0
        self.room = V.EXACT


def _sum_round(codebooks: np.ndarray):
    """Sums and counts of the points of each codebook entry, one row per entry and task."""
    w = codebooks.shape[2]

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sums(codebooks.shape)
        for part, n, points, box, sums, some in _each(codebooks, batches):
            most = max(V.largest(*box)) * n
            if len(some) == 1 and most < V.EXACT:
                held.add(part, some, np.array([n]), np.array(sums)[None, :], most)
                continue
            x = _read(points, n, w)
            own, at, counts = np.unique(nearest(x, codebooks[part][some])[0], return_inverse=True, return_counts=True)
            x = x if most < V.EXACT else V.whole(x)
            total = np.zeros((len(own), w), x.dtype)
            np.add.at(total, at, x)
            held.add(part, some[own], counts, total, most)
        held.flush()
        part, entry = np.nonzero(held.count)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(held.count[part, entry]),
                 pa.array([[str(x) for x in row] for row in held.whole[part, entry]], pa.list_(pa.string()))], ["part", "entry", "n", "sums"])
    return run


def _final_round(codebooks: np.ndarray):
    w = codebooks.shape[2]

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uids, (part, n, points, _, _, some) in zip(batch.column(1).to_pylist(), _each(codebooks, [batch]), strict=True):
                best, error = nearest(_read(points, n, w), codebooks[part][some])
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(uids, np.int64)), pa.array(np.full(n, part, np.int32)), pa.array(some[best].astype(np.int32)), pa.array(V.as_long(error))],
                                                 ["uid", "part", "entry", "error"])
    return run


def train(blocks: DataFrame, codebooks: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (part, entry, component) after ``rounds`` of assigning and averaging."""
    w = codebooks.shape[2]
    for _ in range(rounds):
        found = blocks.mapInArrow(_sum_round(codebooks), "part int, entry int, n long, sums array<string>")
        sums = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(w)]
        for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():        # at most PARTS * ENTRIES rows
            codebooks[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(w)]
    return codebooks


def compress(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the rows with a usable vector.

    Components become floor(1024 x). Codebooks start as the parts of the 256 smallest ids (ties
    of repeated ids by the vector, null ids last). Rows whose vector is null or holds null or
    non-finite components are left out; equal rows stay apart. Vectors of another length are
    compressed with codebooks of their own; a length that four does not divide has a null code,
    error and hash. Sums are exact up to 38 digits; an error beyond a long raises OverflowError.
    An empty table gives none; other columns are ignored.
    """
    v = F.col("v")
    rows = table.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = materialize(rows.filter(fine), "vectors")
    found, base = None, kept.select("uid", "vec_id", "label", F.size("v").alias("d"))
    for d in sorted(r[0] for r in base.select("d").distinct().collect()):
        if d % PARTS:
            continue
        coded, digest = _compress_length(kept.filter(F.size("v") == d), d, rounds)
        coded = coded.withColumn("codebooks_sha256", F.lit(digest))
        found = coded if found is None else found.unionByName(coded)
    if found is None:
        found = table.sparkSession.createDataFrame([], "uid long, code string, error long, codebooks_sha256 string")
    coded = materialize(base.join(found, "uid", "left"), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left").select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _compress_length(rows: DataFrame, d: int, rounds: int) -> tuple[DataFrame, str]:
    w = d // PARTS
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    x = np.floor(SCALE * np.array([r[0] for r in first], dtype=np.float64).reshape(len(first), d))
    codebooks = np.stack([x[:, p * w:(p + 1) * w] for p in range(PARTS)])
    if V.largest(codebooks)[0] >= V.EXACT:
        codebooks = V.whole(codebooks)
    parts = [F.slice("v", p * w + 1, w) for p in range(PARTS)]
    at = rows.agg(*[f(g(p)) for p in parts for f, g in ((F.min, F.array_min), (F.max, F.array_max))]).first()
    low, high = ([np.floor(SCALE * (y or 0.0)) for y in at[s::2]] for s in (0, 1))
    points = rows.select("uid", "v").mapInArrow(_points(d, low, high), "part int, key long, uid long, point binary")
    order = ["part", "key", "uid"]                      # equal points are spread over ranges by uid
    blocks = materialize(points.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack(w), BLOCKS), "blocks")
    codebooks = train(blocks, codebooks, rounds)
    digest = hashlib.sha256(",".join(str(int(y)) for y in codebooks.ravel()).encode()).hexdigest()
    coded = blocks.mapInArrow(_final_round(codebooks), "uid long, part int, entry int, error long")
    code = [F.lower(F.lpad(F.hex(F.max(F.when(F.col("part") == p, F.col("entry")))), 2, "0")) for p in range(PARTS)]
    return coded.groupBy("uid").agg(F.concat(*code).alias("code"), F.sum("error").alias("error")), digest

"""Hard-negative mining with rotated one-bit codes.

Every vector v = |v| u is rotated by a fixed orthonormal matrix and coded in
LEVELS rounds: the signs of what is left of u, as a unit vector s, and the stored
alignment a = <left, s>; a * s is taken off and the next round codes the rest. The
length t of the last rest is stored too. The last rest is orthogonal to the last s,
so for a rotated query q (Cauchy-Schwarz)

    <q, v> = |v| * (sum a <q, s> + <q, rest>),  |<q, rest>| <= t * sqrt(|q|^2 - <q, last s>^2)

<q, s> is estimated by population counts of the code against the bit planes of q
rounded to PLANES bits; the rounding adds at most its L1 norm / sqrt(d). Both give
an interval that always holds the product. Rows whose interval can't reach a list
are dropped, what survives is scored by exact integer products. A round leaves about
0.6 of a random direction: one round drops 2 % of the pairs of check_s, eight 82 %.

The index (codes, alignments, integer components) is written once. Anchors are a
stated set; they are numbered in blocks of about ANCHOR_BLOCK, and the driver holds
one block at a time: one pass over the index finds the positives of the block, one
more its negatives, and each result is written before the next block.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm import intvec as V
from retailcast.llm.textvec import frugal
from retailcast.session import materialize, shared_path

SCALE, SEED = 256.0, 20_270_311
LEVELS, PLANES = 8, 8
ANCHOR_BLOCK, ANCHOR_TILE, VECTOR_BLOCK = 2_048, 128, 4_096
#: Relative slack for the rounding of doubles in the bounds.
SLACK = 1e-9
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
INDEX = "vec_id long, label long, x array<double>, length double, rest double, align array<double>, code array<long>"


def rotation(d: int) -> np.ndarray:
    """The fixed orthonormal matrix of dimension ``d``."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    n, d = bits.shape
    held = np.zeros((n, -(-d // 64) * 64), dtype=bool)
    held[:, :d] = bits
    return np.packbits(held, axis=1, bitorder="little").view("<u8")


def encode(x: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(length, length of the rest of the unit vector, alignments, code words by round) of integer rows."""
    n, d = x.shape
    top = np.abs(x).max(axis=1, initial=0)
    small = x / np.where(top > 0, top, 1)[:, None]          # squares of large components stay finite
    unit = np.sqrt((small * small).sum(axis=1))
    left = (small / np.where(unit > 0, unit, 1)[:, None]) @ rotation(d).T
    align, code = np.zeros((n, levels)), []
    for k in range(levels):
        bits = left >= 0
        align[:, k] = np.abs(left).sum(axis=1) / math.sqrt(max(d, 1))
        left = left - np.where(bits, 1.0, -1.0) * (align[:, k] / math.sqrt(max(d, 1)))[:, None]
        code.append(pack(bits))
    return top * unit, np.sqrt((left * left).sum(axis=1)), align, np.stack(code, axis=1)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, VECTOR_BLOCK):
            part = batch.slice(at, VECTOR_BLOCK)
            for rows, x in V.matrices(part.column(2), SCALE):
                length, rest, align, code = encode(x)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), a.shape[1]) if a.shape[1] else pa.array([[]] * len(a), pa.list_(pa.float64()))
                         for a in (x, align)]
                words = code.reshape(len(rows), -1).view(np.int64)
                words = pa.FixedSizeListArray.from_arrays(pa.array(words.ravel()), words.shape[1]) if words.shape[1] else pa.array([[]] * len(rows), pa.list_(pa.int64()))
                own = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own), lists[0].cast(pa.list_(pa.float64())), pa.array(length), pa.array(rest),
                     lists[1].cast(pa.list_(pa.float64())), words.cast(pa.list_(pa.int64()))],
                    ["vec_id", "label", "x", "length", "rest", "align", "code"])


def index(table: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The stored index of the usable rows of ``table``."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    return materialize(rows.filter("vec_id is not null and label is not null and v is not null").mapInArrow(frugal(_encode), INDEX), "onebit")


class Anchors:
    """A block of anchors of one dimension with their bit planes."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, x: np.ndarray):
        self.ids, self.label, self.x = ids, label, x
        d = x.shape[1]
        turned = x @ rotation(d).T
        self.length = np.sqrt((x * x).sum(axis=1))
        half = 2 ** (PLANES - 1) - 1
        step = np.abs(turned).max(axis=1, initial=0) / half
        step = np.where(step > 0, step, 1)[:, None]
        near = np.rint(turned / step)
        self.total = near.sum(axis=1)
        shifted = (near + half).astype(np.int64)
        self.planes = [pack((shifted >> p) & 1 == 1) for p in range(PLANES)]
        self.half, self.unit = half, step[:, 0] / math.sqrt(max(d, 1))
        self.off = np.abs(turned - near * step).sum(axis=1) / math.sqrt(max(d, 1))

    def bounds(self, q: np.ndarray, block: Part) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the products of anchors ``q`` with the block's vectors."""
        middle = np.zeros((len(q), len(block.ids)))
        for k in range(block.code.shape[1]):
            words = block.code[:, k]
            count = np.zeros(middle.shape, dtype=np.int32)
            for w in range(words.shape[1]):
                for p, plane in enumerate(self.planes):
                    count += np.bitwise_count(plane[q][:, w, None] & words[None, :, w]).astype(np.int32) << p
            ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
            dots = 2.0 * (count - self.half * ones[None, :]) - self.total[q][:, None]
            along = dots * self.unit[q][:, None]
            middle += along * block.align[:, k]
        off, length = self.off[q][:, None], self.length[q][:, None]
        known = np.maximum(np.abs(along) - off, 0)
        wide = off * block.align.sum(axis=1) + np.sqrt(np.maximum(length * length - known * known, 0)) * block.rest
        wide += SLACK * self.length[q][:, None] * (2 + block.align.sum(axis=1))
        return (middle - wide) * block.length - 1e-6, (middle + wide) * block.length + 1e-6


class Block:
    """Vectors of one dimension, read from the index."""

    def __init__(self, batch: pa.RecordBatch, rows: np.ndarray, x: np.ndarray):
        own = pa.array(rows)
        self.x = x
        self.ids, self.label, self.length, self.rest = (batch.column(i).take(own).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 4))
        self.align, code = (batch.column(i).take(own).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1) for i in (5, 6))
        self.code = code.astype(np.int64).view(np.uint64).reshape(len(rows), self.align.shape[1], -1)


class Lists:
    """The best rows of many lists so far: scores descending, ties to the smaller id."""

    def __init__(self, size: int, k: int):
        self.k, self.score, self.own = k, [np.zeros(0, np.int64)] * size, [np.zeros(0, np.int64)] * size
        self.least = np.full(size, -np.inf)                 # the k-th score

    def add(self, lists: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        order = np.argsort(lists, kind="stable")
        lists, ids, scores = lists[order], ids[order], scores[order]
        cuts = np.flatnonzero(np.diff(lists, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = lists[a]
            score, own = np.concatenate([self.score[at], scores[a:b]]), np.concatenate([self.own[at], ids[a:b]])
            rank = np.lexsort((own, -score))
            _, first = np.unique(own[rank], return_index=True)          # an id that came twice counts once
            rank = rank[np.sort(first)][: self.k]
            self.score[at], self.own[at] = score[rank], own[rank]
            if len(rank) == self.k:
                self.least[at] = score[rank[-1]]


def _score(anchors: Anchors, block: Block, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64)] + [V.row_products(anchors.x[q[a:a + 65_536]], block.x[v[a:a + 65_536]]) for a in range(0, len(q), 65_536)])


def _floor_at(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row; -inf where a row has fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def near(anchors: Anchors, block: Block, lists: Lists) -> None:
    """Add the block's rows of the anchors' labels to the anchors' lists of positives."""
    for label in np.unique(block.label):
        own = np.flatnonzero(block.label == label)
        part = Part(block, own)
        some = np.flatnonzero(anchors.label == label)
        for at in range(0, len(some), ANCHOR_TILE):
            q = some[at:at + ANCHOR_TILE]
            low, high = anchors.bounds(q, part)
            other = anchors.ids[q][:, None] != part.ids[None, :]
            low = np.where(other, low, -np.inf)
            # ids that come twice would count twice among the k lower bounds
            least = _floor_at(low, lists.k) if part.distinct else np.full(len(q), -np.inf)
            i, j = np.nonzero(other & (high >= np.maximum(least, lists.least[q])[:, None]))
            lists.add(q[i], part.ids[j], _score(anchors, part, q[i], j))


class Part:
    """Rows of a block."""

    def __init__(self, block: Block, own: np.ndarray):
        for name in ("x", "ids", "label", "length", "rest", "align", "code"):
            setattr(self, name, getattr(block, name)[own])
        self.distinct = len(np.unique(self.ids)) == len(self.ids)


def between(anchors: Anchors, block: Block, windows: np.ndarray, lists: Lists, share: tuple[int, int]) -> None:
    """Add the block's rows of other labels to the lists of their windows.

    ``windows``: (anchor, positive score) by list. A row is in the window of positive
    score s when share[0] * s <= 100 * score <= share[1] * s.
    """
    part = Part(block, np.arange(len(block.ids)))
    for at in range(0, len(anchors.ids), ANCHOR_TILE):
        q = np.arange(at, min(at + ANCHOR_TILE, len(anchors.ids)))
        mine = np.flatnonzero((windows[:, 0] >= at) & (windows[:, 0] < at + len(q)))
        if not len(mine):
            continue
        low, high = anchors.bounds(q, part)
        other = (anchors.ids[q][:, None] != part.ids[None, :]) & (anchors.label[q][:, None] != part.label[None, :])
        wanted = np.zeros(other.shape, dtype=bool)
        least, most = (np.array([s * int(p) / 100 for p in windows[mine, 1]]) for s in share)
        place = windows[mine, 0].astype(np.int64) - at
        for a in range(0, len(mine), 64):
            m, w = mine[a:a + 64], place[a:a + 64]
            lo, hi, bottom, top = low[w], high[w], least[a:a + 64, None], most[a:a + 64, None]
            room = 1e-6 + 1e-12 * np.abs(top)
            sure = other[w] & (lo > bottom + room) & (hi < top - room)
            floor = _floor_at(np.where(sure, lo, -np.inf), lists.k) if part.distinct else np.full(len(m), -np.inf)
            floor = np.maximum(floor, lists.least[m])[:, None]
            hit = other[w] & (lo <= top + room) & (hi >= np.maximum(bottom - room, floor))
            np.logical_or.at(wanted, w, hit)
        i, j = np.nonzero(wanted)
        scores = _score(anchors, part, q[i], j)
        # scored once for all windows of the anchor, then dealt to those that hold the score
        order = np.argsort(place, kind="stable")
        first, last = np.searchsorted(place[order], [i, i + 1])
        width = last - first
        pair = np.repeat(np.arange(len(i)), width)
        which = mine[order[np.repeat(first, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)]]
        goal, score = windows[which, 1], scores[pair]
        if len(score) and max(np.abs(goal).max(), np.abs(score).max()) >= 2**55:
            goal, score = goal.astype(object), score.astype(object)
        held = (share[0] * goal <= 100 * score) & (100 * score <= share[1] * goal)
        held = held.astype(bool) & (scores[pair] >= lists.least[which])
        lists.add(which[held], part.ids[j[pair[held]]], scores[pair[held]])


def _by_dimension(rows: list) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    size = np.array([len(r["x"]) for r in rows])
    out = []
    for d in np.unique(size):
        own = [rows[i] for i in np.flatnonzero(size == d)]
        out.append((np.array([r["vec_id"] for r in own]), np.array([r["label"] for r in own]), np.array([r["x"] for r in own], dtype=float).reshape(len(own), d)))
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, VECTOR_BLOCK):
            part = batch.slice(at, VECTOR_BLOCK)
            for rows, x in V.matrices(part.column(2), 1.0):
                yield Block(part, rows, x)


def _near_pass(groups: list, k: int):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {x.shape[1]: (Anchors(ids, label, x), Lists(len(ids), k)) for ids, label, x in groups}
        for block in _blocks(batches):
            if block.x.shape[1] in held:
                anchors, lists = held[block.x.shape[1]]
                near(anchors, block, lists)
        for anchors, lists in held.values():
            for i, own in enumerate(lists.own):
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), anchors.ids[i])), pa.array(own), pa.array(lists.score[i])], ["anchor_id", "positive_id", "positive_score"])
    return run


def _between_pass(groups: list, goals: dict[int, list[int]], k: int, share: tuple[int, int]):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for ids, label, x in groups:
            windows = np.array([(i, s) for i, a in enumerate(ids) for s in goals.get(int(a), [])], dtype=np.int64).reshape(-1, 2)
            held[x.shape[1]] = Anchors(ids, label, x), windows, Lists(len(windows), k)
        for block in _blocks(batches):
            if block.x.shape[1] in held:
                anchors, windows, lists = held[block.x.shape[1]]
                between(anchors, block, windows, lists, share)
        for anchors, windows, lists in held.values():
            for i, own in enumerate(lists.own):
                if len(own):
                    n = len(own)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, anchors.ids[windows[i, 0]])), pa.array(np.full(n, windows[i, 1])), pa.array(own), pa.array(lists.score[i])],
                                                     ["anchor_id", "positive_score", "negative_id", "negative_score"])
    return run


def _first(found: DataFrame, group: list[str], own: str, score: str, k: int) -> DataFrame:
    """The ``k`` best rows of each group with their ``rank``."""
    best = found.groupBy(*group, own).agg(F.max(score).alias(score))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(score), own))).filter(F.col("rank") <= k)


def hard_negatives(table: DataFrame, label: Column | None = None, every: int = 100, positives: int = 5, negatives: int = 10, share: tuple[int, int] = (30, 90),
                   id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``; ``label`` (the label column) says
    which rows are positives. For each of an anchor's ``positives`` best rows of its label the
    ``negatives`` best rows of other labels come back whose score is between ``share`` hundredths
    of the positive's score; scores are inner products of the components' floor(256 x), ties go
    to the smaller id. Fewer rows are all listed; a negative positive score has no window.

    Rows with a null id, label or vector or with a null or non-finite component take no part.
    Vectors of different lengths are not compared. Equal rows count once; of an id with several
    rows each row takes part, and a partner's best score counts. A score beyond a long raises
    OverflowError. An empty table gives none; other columns are ignored.
    """
    spark = table.sparkSession
    stored = index(table, F.col("label") if label is None else label, id_col, vector_col)
    anchors = stored.filter(F.col("vec_id") % every == 0).select("vec_id", "label", "x").distinct()
    n = stored.filter(F.col("vec_id") % every == 0).count()
    blocks = max(1, -(-n // ANCHOR_BLOCK))
    numbered = materialize(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "anchors")
    out = shared_path(spark, f"tables/negatives-{uuid.uuid4().hex[:12]}")
    for b in range(blocks):
        groups = _by_dimension(numbered.filter(F.col("block") == b).collect())         # about ANCHOR_BLOCK rows
        if not groups:
            continue
        near_rows = stored.mapInArrow(_near_pass(groups, positives), "anchor_id long, positive_id long, positive_score long")
        near_rows = materialize(_first(near_rows, ["anchor_id"], "positive_id", "positive_score", positives).drop("rank"), "positives")
        goals: dict[int, set] = {}
        for r in near_rows.select("anchor_id", "positive_score").distinct().collect():
            goals.setdefault(r[0], set()).add(r[1])
        far_rows = stored.mapInArrow(_between_pass(groups, {a: sorted(s) for a, s in goals.items()}, negatives, share),
                                     "anchor_id long, positive_score long, negative_id long, negative_score long")
        far_rows = _first(far_rows, ["anchor_id", "positive_score"], "negative_id", "negative_score", negatives)
        near_rows.join(far_rows, ["anchor_id", "positive_score"]).select(*RESULT).write.parquet(f"{out}/block={b}")
    if not n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return spark.read.parquet(out).select(*RESULT)

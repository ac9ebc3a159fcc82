"""Second-order gradient-boosted regression trees over binned features.

Features become bins once (a byte each). Every level of a tree is one pass: tasks
apply the trees since the last stored prediction, sum gradients and row counts by
(node, feature, bin) in numpy, and Spark adds the tasks' histograms up; their size is
fixed by nodes, features and bins, not by rows. The driver picks the splits. Only the
tree's own columns are counted, and of two siblings the one with fewer rows: the sums are
whole numbers, so the other's are exactly its parent's less these.

For squared error the gradient is prediction - label and the Hessian 1. Gradients are
summed as whole numbers of 2^-bits, so a fit gives the same trees however the rows
are partitioned. Split gain and leaf value carry the L2 term:

    gain = GL^2 / (HL + L2) + GR^2 / (HR + L2) - G^2 / (H + L2),  value = -rate * G / (H + L2)

A fit of more than STORE rounds runs as one job: its tasks run at once, keep their rows in a file, and add
their histograms up through the shared folder. Short fits and clusters where that can't be go pass by pass.

Rows and columns are sampled per tree; a missing value goes to the side that gains more.
Trees are only ever appended: a fit can be continued, and early stopping keeps a prefix.
"""

from __future__ import annotations

import json
import math
import os
import pickle
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.session import materialize, shared_path

#: Rounds after which predictions are stored and the curve is extended.
STORE = 5
#: Tasks whose histograms the driver adds up itself; those of more are added up by a shuffle first.
DIRECT = 64
#: The bin of a missing value.
MISSING = 255
MIN_GAIN = 1e-6
NODES = ("treeID int, id int, leftChild int, rightChild int, featureIndex int, threshold double, missing_left boolean, "
         "prediction double, gain double, rawCount bigint, tree_weight double")


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2 i + 1 and 2 i + 2; ``feature`` -1 is a leaf."""

    depth: int
    feature: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 ** (self.depth + 1) - 1
        self.feature, self.cut = np.full(n, -1), np.zeros(n, np.int64)
        self.threshold, self.missing_left = np.zeros(n), np.zeros(n, bool)
        self.value, self.gain, self.cover = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)

    def node_of(self, bins: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """The node that each row of bins (feature by row) has reached, or each of the rows ``own``."""
        rows = np.arange(bins.shape[1]) if own is None else own
        inner = np.flatnonzero(self.feature >= 0)
        at = np.zeros(len(rows), np.int64)
        if not len(inner):
            return at
        to = np.repeat(np.arange(len(self.feature))[:, None], 256, axis=1)          # (node, bin) -> the next node; leaves stay
        left = np.arange(256)[None, :] <= self.cut[inner, None]
        left[:, MISSING] = self.missing_left[inner]
        to[inner] = 2 * inner[:, None] + 2 - left
        to, flat, start = to.ravel(), bins.reshape(-1), np.maximum(self.feature, 0) * bins.shape[1]
        for level in range(int(inner[-1] + 1).bit_length()):
            b = flat[start[0] + rows] if level == 0 else flat.take(start.take(at) + rows)
            at = to.take(at * 256 + b)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Leaf values of rows of raw features."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[at]
            v = x[rows, np.maximum(f, 0)]
            left = np.where(np.isnan(v), self.missing_left[at], v <= self.threshold[at])
            at = np.where(f < 0, at, 2 * at + 2 - left)
        return self.value[at]


@dataclass
class Booster:
    features: list[str]
    params: dict
    base: float
    trees: list[Tree]

    def prefix(self, rounds: int) -> Booster:
        """The model of the first ``rounds`` trees."""
        return Booster(self.features, self.params, self.base, self.trees[:rounds])

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.predict(x)
        return out

    def rows(self) -> list[tuple]:
        """Node rows; tree 0 is the intercept, one leaf."""
        cover = int(self.trees[0].cover[0]) if self.trees else 1
        out = [(0, 0, -1, -1, -1, None, False, float(self.base), 0.0, cover, 1.0)]
        for k, t in enumerate(self.trees):
            for i in range(len(t.feature)):
                if i and t.feature[(i - 1) // 2] < 0:
                    continue
                inner = t.feature[i] >= 0
                out.append((k + 1, i, 2 * i + 1 if inner else -1, 2 * i + 2 if inner else -1, int(t.feature[i]), float(t.threshold[i]) if inner else None,
                            bool(t.missing_left[i]), float(t.value[i]), float(t.gain[i]), int(t.cover[i]), 1.0))
        return out


def bin_edges(df: DataFrame, features: Sequence[str], bins: int, equal_width: bool = False) -> list[list[float]]:
    """Ascending cut points of each feature, at most ``bins``: midpoints between neighbouring
    quantiles (all distinct values where there are as few), or of equal width over the range."""
    if not 2 <= bins < MISSING:
        raise ValueError(f"2 to {MISSING - 1} bins")
    cols = [F.col(c).cast("double") for c in features]
    some = [F.when(~F.isnan(c), c) for c in cols]
    if equal_width:
        row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(some) for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
        out = []
        for i in range(len(cols)):
            lo, hi = row[f"lo{i}"], row[f"hi{i}"]
            out.append([] if lo is None or lo == hi else [lo + (hi - lo) * (2 * j + 1) / (2 * bins) for j in range(bins)])
        return out
    at = [i / bins for i in range(bins + 1)]
    row = df.agg(*[F.percentile_approx(c, at, 50 * bins).alias(f"q{i}") for i, c in enumerate(some)]).first()
    out = []
    for i in range(len(cols)):
        q = sorted(set(row[f"q{i}"] or []))
        out.append(sorted({float_safe((a + b) / 2) for a, b in zip(q, q[1:], strict=False)}))
    return out


def float_safe(cut: float) -> float:
    """The number halfway between two neighbouring floats beside ``cut``: a value and the float it
    is sent as in a request fall on the same side."""
    f = np.float32(cut)
    return (float(f) + float(np.nextafter(f, np.float32(np.inf)))) / 2


def _numbers(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Feature columns as doubles, missing ones as NaN."""
    return np.stack([batch.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64) for n in names], axis=1) if names else np.zeros((batch.num_rows, 0))


#: Rows travel in blocks of up to BLOCK of one side, so that a pass costs little but its arithmetic.
#: ``took`` has a bit for each of the next STORE trees: whether the row is in its sample.
ROWS, BLOCK = "side int, n int, key binary, took binary, y binary, bins binary, pred binary", 32_768
#: What a histogram pass needs of them.
LIVE = ["n", "took", "y", "bins", "pred"]


def _short(y: np.ndarray) -> bytes:
    """Labels as floats where that loses nothing, else as doubles."""
    small = y.astype(np.float32)
    return (small if np.array_equal(small.astype(np.float64), y, equal_nan=True) else y).tobytes()


def _bin_pass(names: list[str], edges: list[list[float]], start: Booster, p: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(side: int) -> pa.RecordBatch:
            key, y, out, pred = (np.concatenate(a, axis=-1) for a in zip(*held.pop(side), strict=True))
            cols = [pa.array([a], pa.binary()) for a in (key.tobytes(), taken(key, p, len(start.trees)).tobytes(), _short(y), out.tobytes(), pred.tobytes())]
            return pa.RecordBatch.from_arrays([pa.array([side], pa.int32()), pa.array([len(key)], pa.int32()), *cols], ["side", "n", "key", "took", "y", "bins", "pred"])
        for batch in batches:
            x = _numbers(batch, names)
            out = np.empty(x.shape[::-1], np.uint8)
            for f, e in enumerate(edges):
                out[f] = np.where(np.isnan(x[:, f]), MISSING, np.searchsorted(e, x[:, f], side="left"))
            side, key, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("side", "key", "y"))
            pred = start.predict(x)
            for s in np.unique(side):
                own = np.flatnonzero(side == s)
                for at in range(0, len(own), BLOCK):
                    part = own[at:at + BLOCK]
                    if sum(len(k) for k, *_ in held.get(s, [])) + len(part) > BLOCK:
                        yield block(s)
                    held.setdefault(s, []).append((key[part], y[part], out[:, part], pred[part]))
        for s in list(held):
            yield block(s)
    return run


def _blocks(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(one-row batch, bins by feature, samples, label, prediction) of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            n, took, y, bins, pred = (batch.column(c)[i] for c in LIVE)
            n, label = n.as_py(), y.as_buffer()
            yield (batch.slice(i, 1), np.frombuffer(bins.as_buffer(), np.uint8).reshape(n_features, n), np.frombuffer(took.as_buffer(), np.uint8),
                   np.frombuffer(label, np.float32 if label.size == 4 * n else np.float64).astype(np.float64), np.frombuffer(pred.as_buffer()))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, for sampling rows by key."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows the tree learns from; a row's fate depends on its key, the seed and the tree only."""
    if share >= 1:
        return np.ones(len(key), bool)
    salt = np.uint64((seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 % 2**64)
    return _mix(key.view(np.uint64) ^ salt) < np.uint64(int(share * 2**64))


def taken(key: np.ndarray, p: dict, first: int) -> np.ndarray:
    """Bit i: whether the row is in the sample of tree ``first`` + i."""
    out = np.zeros(len(key), np.uint8)
    for i in range(STORE):
        out |= sampled(key, p["seed"], first + i, p["subsample"]).astype(np.uint8) << np.uint8(i)
    return out


def _histogram_pass(trees: list[Tree], now: Tree, counted: list[int], width: int, bits: int, columns: np.ndarray, packed: bool):
    """Gradient sums and row counts by (feature, one of the nodes ``counted`` and bin): as rows, or ``packed`` as one row with both arrays."""
    n_features, size = len(columns), len(counted) * width
    place = np.full(len(now.feature), -1)
    place[counted] = np.arange(len(counted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g_sum, count = (np.zeros((n_features, size), np.int64) for _ in range(2))
        for _, bins, took, y, pred in _blocks(batches, n_features):
            own = np.flatnonzero(took >> np.uint8(len(trees)) & np.uint8(1))
            at = place[now.node_of(bins, own)]
            own, at = own[at >= 0], at[at >= 0] * width
            margin = pred[own]
            for t in trees:
                margin = margin + t.value[t.node_of(bins, own)]
            g = np.floor((margin - y[own]) * 2.0**bits + 0.5)
            for f in np.flatnonzero(columns):
                i = at + np.minimum(bins[f].take(own), width - 1)              # the last slot is the missing one
                g_sum[f] += np.bincount(i, weights=g, minlength=size).astype(np.int64)
                count[f] += np.bincount(i, minlength=size)
        if packed:
            yield pa.RecordBatch.from_arrays([pa.array([g_sum.tobytes()], pa.binary()), pa.array([count.tobytes()], pa.binary())], ["g", "n"])
            return
        f, i = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(f.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(g_sum[f, i]), pa.array(count[f, i])], ["feature", "slot", "g", "n"])
    return run


def _advance_pass(trees: list[Tree], n_features: int, p: dict, done: int):
    """Blocks with their prediction after ``trees`` and the samples of the trees from ``done`` on, and the sum of squared errors after each of ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, bins, _, y, pred in _blocks(batches, n_features):
            errors = []
            for t in trees:
                pred = pred + t.value[t.node_of(bins)]
                errors.append(float(((pred - y) ** 2).sum()))
            took = taken(np.frombuffer(block.column("key")[0].as_buffer(), np.int64), p, done)
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in ("side", "n", "key")), pa.array([took.tobytes()], pa.binary()), *(block.column(c) for c in ("y", "bins")),
                                              pa.array([pred.tobytes()], pa.binary()), pa.array([errors], pa.list_(pa.float64()))],
                                             ["side", "n", "key", "took", "y", "bins", "pred", "errors"])
    return run


def best_split(g: np.ndarray, n: np.ndarray, p: dict, columns: np.ndarray) -> tuple | None:
    """(gain, feature, cut, missing left, GL, HL) of a node from its histograms (feature, bin; the last
    bin is the missing one). Ties go to the lower feature, then the lower cut, then missing right."""
    any_column = int(columns.argmax())
    l2, total_g, total_n = p["reg_lambda"], g[any_column].sum(), n[any_column].sum()
    best = None
    left_g, left_n = np.cumsum(g[:, :-1], axis=1)[:, :-1], np.cumsum(n[:, :-1], axis=1)[:, :-1]
    for missing_left in (False, True):
        gl, hl = left_g + (g[:, -1:] if missing_left else 0), left_n + (n[:, -1:] if missing_left else 0)
        gr, hr = total_g - gl, total_n - hl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - total_g * total_g / (total_n + l2)
        fine = (hl >= max(p["min_child_weight"], 1)) & (hr >= max(p["min_child_weight"], 1)) & columns[:, None]
        gain = np.where(fine, gain, -np.inf)
        if gain.size and gain.max() > MIN_GAIN:
            f, c = np.unravel_index(int(gain.argmax()), gain.shape)
            if best is None or (-gain[f, c], f, c) < (-best[0], best[1], best[2]):
                best = (float(gain[f, c]), int(f), int(c), missing_left, float(gl[f, c]), int(hl[f, c]))
    return best


def drawn(index: int, p: dict, n_features: int) -> np.ndarray:
    """Which columns the tree ``index`` learns from."""
    rng = np.random.default_rng([p["seed"], index])
    columns = np.zeros(n_features, bool)
    columns[rng.choice(n_features, max(1, int(n_features * p["colsample_bytree"])), replace=False)] = True
    return columns


def grow(count: Callable[[Tree, list[int], np.ndarray], tuple[np.ndarray, np.ndarray]], index: int, p: dict, edges: list[list[float]], bits: int) -> Tree:
    """The next tree: one histogram pass a level; ``count`` gives gradient sums and row counts by feature, node and bin."""
    width = max(len(e) for e in edges) + 2
    columns = drawn(index, p, len(edges))
    tree, stats = Tree(p["max_depth"]), {}
    open_nodes, sums = [0], {}
    for level in range(p["max_depth"]):
        counted = open_nodes if level == 0 else [min(pair, key=lambda i: stats[i][1]) for pair in zip(open_nodes[::2], open_nodes[1::2], strict=True)]
        g, n = count(tree, counted, columns)
        above, sums = sums, {i: (g[:, k * width:(k + 1) * width], n[:, k * width:(k + 1) * width]) for k, i in enumerate(counted)}
        for i in counted if level else []:
            sums[i - 1 if i % 2 == 0 else i + 1] = tuple(whole - part for whole, part in zip(above[(i - 1) // 2], sums[i], strict=True))
        if level == 0:
            any_column = int(columns.argmax())
            stats[0] = float(g[any_column].sum() / 2.0**bits), int(n[any_column].sum())
        following = []
        for i in open_nodes:
            split = best_split(sums[i][0] / 2.0**bits, sums[i][1], p, columns)
            if split is None:
                continue
            tree.gain[i], f, cut, tree.missing_left[i], gl, hl = split
            tree.feature[i], tree.cut[i], tree.threshold[i] = f, cut, edges[f][cut] if cut < len(edges[f]) else math.inf
            stats[2 * i + 1], stats[2 * i + 2] = (gl, hl), (stats[i][0] - gl, stats[i][1] - hl)
            following += [2 * i + 1, 2 * i + 2]
        open_nodes = following
        if not open_nodes:
            break
    for i, (gi, hi) in stats.items():
        tree.value[i], tree.cover[i] = -p["learning_rate"] * gi / (hi + p["reg_lambda"]) if hi + p["reg_lambda"] > 0 else 0.0, hi
    return tree



def _passes(rows: DataFrame, tasks: int, since: list[Tree], edges: list[list[float]], bits: int):
    """``count`` of ``grow`` as one Spark pass over the blocks ``rows``, stored with the last tree before ``since``."""
    n_features, width = len(edges), max(len(e) for e in edges) + 2

    def count(tree: Tree, counted: list[int], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        task = _histogram_pass(since, tree, counted, width, bits, columns, tasks <= DIRECT)
        g, n = (np.zeros((n_features, len(counted) * width), np.int64) for _ in range(2))
        if tasks <= DIRECT:
            for r in rows.mapInArrow(task, "g binary, n binary").toArrow().to_pylist():
                g += np.frombuffer(r["g"], np.int64).reshape(g.shape)
                n += np.frombuffer(r["n"], np.int64).reshape(n.shape)
        else:
            found = rows.mapInArrow(task, "feature int, slot int, g long, n long").groupBy("feature", "slot").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toArrow()
            at = found.column("feature").to_numpy(), found.column("slot").to_numpy()
            g[at], n[at] = found.column("g").to_numpy(), found.column("n").to_numpy()
        return g, n
    return count


# -- long fits: all tasks at once, each keeping its rows -------------------------

def bundles(sizes: Sequence[int]) -> list[list[int]]:
    """Features grouped so that the codes of a group, one for each combination of its bins, fit a byte."""
    out: list[list[int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
        home = next((g for g in out if math.prod(sizes[i] for i in g) * sizes[f] <= 256), None)
        if home is None:
            out.append(home := [])
        home.append(f)
    return out


class _Spool:
    """Arrays in a file without a name: a task's memory doesn't grow with its rows, and the system's file cache keeps what fits."""

    def __init__(self):
        self.file, self.end = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None), 0

    def put(self, a: np.ndarray, at: int | None = None) -> int:
        at = self.end if at is None else at
        self.file.seek(at)
        self.file.write(np.ascontiguousarray(a).reshape(-1).view(np.uint8))
        self.end = max(self.end, at + a.nbytes)
        return at

    def get(self, at: int, n: int, kind) -> np.ndarray:
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * np.dtype(kind).itemsize), kind)


class _Board:
    """Sums over a gang's tasks, as files of a folder that all of them see: task 0 adds up and writes the
    total. Spark's own all-gather takes a second a call. A file is deleted when all its readers have gone on."""

    def __init__(self, folder: str, me: int, tasks: int):
        self.folder, self.me, self.tasks, self.step = folder, me, tasks, 0
        os.makedirs(folder, exist_ok=True)

    def _path(self, step: int, name: object) -> str:
        return f"{self.folder}/{step}-{name}"

    def _put(self, path: str, what: object) -> None:
        with open(f"{path}.part", "wb") as f:
            pickle.dump(what, f, pickle.HIGHEST_PROTOCOL)
        os.rename(f"{path}.part", path)

    def _get(self, path: str) -> object:
        wait = 0.0005
        while not os.path.exists(path):                                          # if a task fails, Spark ends all of them
            time.sleep(wait)
            wait = min(1.2 * wait, 0.02)
        with open(path, "rb") as f:
            return pickle.load(f)

    def total(self, mine: tuple) -> tuple:
        """The sums of the tasks' values (arrays, lists or numbers) by place; every task gets the same."""
        step, self.step = self.step, self.step + 1
        if self.me:
            self._put(self._path(step, self.me), mine)
            found = self._get(self._path(step, "total"))
            os.remove(self._path(step, self.me))
            return found
        for i in range(1, self.tasks):
            mine = tuple(a + b for a, b in zip(mine, self._get(self._path(step, i)), strict=True))
        self._put(self._path(step, "total"), mine)
        if step:
            os.remove(self._path(step - 1, "total"))                             # whoever sent this step has read it
        return mine


class _Gang:
    """One task's share of a fit: its blocks, their predictions and the node that each row has reached."""

    def __init__(self, edges: list[list[float]], p: dict, bits: int, total: Callable[[tuple], tuple]):
        self.edges, self.p, self.bits, self.total = edges, p, bits, total
        self.sizes = [len(e) + 2 for e in edges]                                 # the last code of a feature is its missing value
        self.width = max(self.sizes)
        self.groups = bundles(self.sizes)
        self.bin_of: dict[int, tuple[int, np.ndarray]] = {}                      # feature -> its group and its bin by the group's code
        self.stride = {}
        for k, g in enumerate(self.groups):
            stride = 1
            for f in g:
                self.stride[f], self.bin_of[f] = stride, (k, np.arange(256) // stride % self.sizes[f])
                stride *= self.sizes[f]
        self.spool, self.blocks = _Spool(), []
        self.node_type = np.min_scalar_type(2 ** (p["max_depth"] + 1))

    def add(self, side: int, key: np.ndarray, y: np.ndarray, bins: np.ndarray, pred: np.ndarray) -> None:
        codes = np.zeros((len(self.groups), len(key)), np.uint8)
        for f, size in enumerate(self.sizes):
            step = np.minimum(np.arange(256), size - 1) * self.stride[f]   # the bin of a missing value is MISSING
            codes[self.bin_of[f][0]] += step.astype(np.uint8).take(bins[f])
        at = {"codes": self.spool.put(codes), "pred": self.spool.put(pred), "y": self.spool.put(y)}
        if side == 0:
            at |= {"key": self.spool.put(key), "node": self.spool.put(np.zeros(len(key), self.node_type)), "took": self.spool.put(np.zeros(len(key), bool))}
        self.blocks.append((side, len(key), y.dtype, at))

    def _codes(self, n: int, at: dict) -> np.ndarray:
        return self.spool.get(at["codes"], n * len(self.groups), np.uint8)

    def _steps(self, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        """(node, code) -> the next node, and the group that each node looks at; leaves stay."""
        to, group = np.repeat(np.arange(len(tree.feature))[:, None], 256, axis=1), np.zeros(len(tree.feature), np.int64)
        for i in np.flatnonzero(tree.feature >= 0):
            group[i], value = self.bin_of[tree.feature[i]]
            left = np.where(value == self.sizes[tree.feature[i]] - 1, tree.missing_left[i], value <= tree.cut[i])
            to[i] = 2 * i + 2 - left
        return to.reshape(-1), group

    @staticmethod
    def _step(codes: np.ndarray, node: np.ndarray, n: int, to: np.ndarray, group: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return to.take(node * 256 + codes.take((group * n).take(node) + rows))

    def _marginal(self, k: int, sums: np.ndarray, out: np.ndarray, columns: np.ndarray) -> None:
        """Sums by (node, code) of the group ``k`` as sums by node and bin of each of its ``columns``."""
        shape = [self.sizes[f] for f in self.groups[k]][::-1]                    # the first feature changes fastest
        sums = sums[:, :math.prod(shape)].reshape(-1, *shape)
        for j, f in enumerate(self.groups[k]):
            if columns[f]:
                own = len(shape) - j
                by_bin = sums.sum(axis=tuple(a for a in range(1, len(shape) + 1) if a != own))
                out[f, :, :self.sizes[f] - 1], out[f, :, -1] = by_bin[:, :-1], by_bin[:, -1]

    def _count(self, tree: Tree | None, counted: list[int], columns: np.ndarray, before: Tree | None, index: int, first: bool) -> tuple[np.ndarray, np.ndarray, list]:
        """This task's sums of a level. The first pass of a tree adds the tree ``before`` to the predictions,
        gives the squared errors by side and block, and draws the tree's rows; the others take rows one level down."""
        used = [k for k, g in enumerate(self.groups) if columns[g].any()] if counted else []
        size, errors = len(counted) * 256, [[], []]
        g_sum, n_sum = (np.zeros((len(self.groups), size), np.int64) for _ in range(2))
        if first:
            place, (to, group) = None, self._steps(before) if before else (None, None)
        else:
            place = np.full(len(tree.feature), -1)
            place[counted] = np.arange(len(counted)) * 256
            to, group = self._steps(tree)
        for side, n, kind, at in self.blocks:
            if side and not (first and before):
                continue
            codes, rows = self._codes(n, at), np.arange(n)
            pred, y = self.spool.get(at["pred"], n, np.float64), self.spool.get(at["y"], n, kind)
            node = self.spool.get(at["node"], n, self.node_type).astype(np.int64) if side == 0 else np.zeros(n, np.int64)
            if first:
                if before:
                    for _ in range(1 if side == 0 else before.depth):            # rows that learn stand one level above the leaves
                        node = self._step(codes, node, n, to, group, rows)
                    pred = pred + before.value.take(node)
                    self.spool.put(pred, at["pred"])
                    errors[side].append(float(((pred - y) ** 2).sum()))
                if side or not counted:
                    continue
                took = sampled(self.spool.get(at["key"], n, np.int64), self.p["seed"], index, self.p["subsample"])
                self.spool.put(took, at["took"])
                self.spool.put(np.zeros(n, self.node_type), at["node"])
                own = np.flatnonzero(took)
                slot = None
            else:
                node = self._step(codes, node, n, to, group, rows)
                self.spool.put(node.astype(self.node_type), at["node"])
                slot = place.take(node)
                own = np.flatnonzero((slot >= 0) & self.spool.get(at["took"], n, bool))
                slot = slot.take(own)
            g = np.floor((pred.take(own) - y.take(own)) * 2.0**self.bits + 0.5)
            for k in used:
                i = codes[k * n:(k + 1) * n].take(own)
                i = i.astype(np.int64) if slot is None else slot + i
                g_sum[k] += np.bincount(i, weights=g, minlength=size).astype(np.int64)
                n_sum[k] += np.bincount(i, minlength=size)
        out = [np.zeros((len(self.sizes), len(counted), self.width), np.int64) for _ in range(2)]
        for k in used:
            for sums, o in zip((g_sum, n_sum), out, strict=True):
                self._marginal(k, sums[k].reshape(len(counted), 256), o, columns)
        return *out, errors

    def _total(self, g: np.ndarray, n: np.ndarray, errors: list, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """The sums of all tasks; every task gets the same."""
        own = np.zeros((len(self.sizes), self.width), bool)
        for f in np.flatnonzero(columns):
            own[f, :self.sizes[f] - 1] = own[f, -1] = True
        g_all, n_all, *errors = self.total((g.transpose(1, 0, 2)[:, own], n.transpose(1, 0, 2)[:, own], *errors))
        g.transpose(1, 0, 2)[:, own], n.transpose(1, 0, 2)[:, own] = g_all, n_all
        return g.reshape(len(self.sizes), -1), n.reshape(len(self.sizes), -1), errors

    def fit(self, first: int, rounds: int, patience: int | None) -> tuple[list[Tree], list[tuple]]:
        """(new trees, curve); every task comes to the same."""
        rows = self.total(tuple(sum(n for side, n, *_ in self.blocks if side == s) for s in (0, 1)))
        trees, curve = [], []
        while True:
            index, more, before = first + len(trees), len(trees) < rounds, trees[-1] if trees else None
            columns = drawn(index, self.p, len(self.sizes)) if more else np.zeros(len(self.sizes), bool)
            *root, errors = self._total(*self._count(None, [0] if more else [], columns, before, index, True), columns)
            if before:
                curve.append((index - 1, *[math.sqrt(math.fsum(errors[s]) / rows[s]) if rows[s] else None for s in (0, 1)]))
            if not more or patience is not None and curve and rows[1] and index - 1 - min((v, r) for r, _, v in curve)[1] >= patience:
                return trees, curve

            def count(tree: Tree, counted: list[int], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                return tuple(root) if counted == [0] else self._total(*self._count(tree, counted, columns, None, index, False), columns)[:2]
            trees.append(grow(count, index, self.p, self.edges, self.bits))


def _gang_pass(folder: str, edges: list[list[float]], p: dict, bits: int, first: int, rounds: int, patience: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        attempts = context.allGather(uuid.uuid4().hex[:12])                       # a repeated attempt gets a folder of its own
        board = _Board(f"{folder}/{attempts[0]}", context.partitionId(), len(attempts))
        gang = _Gang(edges, p, bits, board.total)
        for batch in batches:
            for side, (block, bins, _, y, pred) in zip(batch.column("side").to_pylist(), _blocks([batch], len(edges)), strict=True):
                gang.add(side, np.frombuffer(block.column("key")[0].as_buffer(), np.int64), y, bins, pred)
        found = gang.fit(first, rounds, patience)
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["found"])
    return run


def gang_size(spark: SparkSession, folder: str) -> int:
    """Tasks that can run at once, or 0 where a fit has to go pass by pass: tasks that come and go, a shared folder
    that isn't a path, or so many tasks that adding up their sums in one of them would cost more than the passes."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true" or not folder.startswith("/"):
        return 0
    scheduler = sc._jsc.sc()
    n = scheduler.maxNumConcurrentTasks(scheduler.resourceProfileManager().defaultResourceProfile())
    return n if n <= DIRECT else 0


def gradient_bits(n: int, spread: float) -> int:
    """Fraction bits of a gradient, so that the sum of ``n`` of them fits a long and a task's sum a double."""
    return max(0, min(20, int(50 - math.log2(max(n, 1)) / 2 - math.log2(max(spread, 1))), int(61 - math.log2(max(n, 1)) - math.log2(max(spread, 1)))))


def fit(train: DataFrame, features: Sequence[str], label: str, params: dict, rounds: int, val: DataFrame | None = None, patience: int | None = None,
        start: Booster | None = None, id_col: str | None = None, bins: int = 64, equal_width: bool = False, bits: int | None = None) -> tuple[Booster, list[tuple]]:
    """(model, [(round, train RMSE, validation RMSE)]) of ``rounds`` more rounds, from ``start`` if given.

    With ``val`` and ``patience`` it stops that many rounds past the best validation round and keeps
    the trees up to it. Rows without a label are left out; without rows the model is the intercept 0.
    Row samples go by ``id_col``, or by the features if there is none.
    """
    p, names = dict(params), list(features)
    sides = [(0, train)] + ([(1, val)] if val is not None else [])
    key = lambda df: F.xxhash64(*([F.col(id_col)] if id_col else [F.col(c).cast("double") for c in names]))
    parts = [df.filter(F.col(label).isNotNull()).select(F.lit(s).alias("side"), key(df).alias("key"), F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in names])
             for s, df in sides]
    n, lo, hi, mean = parts[0].agg(F.count("y"), F.min("y"), F.max("y"), F.avg("y")).first()
    model = start or Booster(names, p, float(mean) if n else 0.0, [])
    if not n:
        return model, []
    bits = gradient_bits(n, 2 * (hi - lo) + abs(model.base) + 1) if bits is None else bits
    edges = bin_edges(parts[0], names, bins, equal_width)
    raw = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    spark = train.sparkSession
    if raw.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        raw = raw.repartition(spark.sparkContext.defaultParallelism)
    rows = materialize(raw.mapInArrow(_bin_pass(names, edges, model, p), ROWS), "binned", compression="zstd")
    trees, curve, done, best = list(model.trees), [], len(model.trees), (math.inf, -1)
    first, folder = done, re.sub("^file:/+", "/", shared_path(spark, f"gangs/{uuid.uuid4().hex[:12]}"))
    tasks = gang_size(spark, folder) if rounds > STORE else 0
    if tasks:
        found = rows.repartition(tasks).mapInArrow(_gang_pass(folder, edges, p, bits, first, rounds, patience), "found binary", barrier=True).collect()
        new, curve = pickle.loads(found[0]["found"])
        trees, done = trees + new, first + rounds
        if patience is not None and curve and curve[-1][2] is not None:
            best = min((v, r) for r, _, v in curve)
    while done - first < rounds:
        since: list[Tree] = []
        live = rows.filter("side = 0").select(*LIVE).persist()             # read by up to STORE x depth passes; a lost copy is read again from the files
        try:
            tasks = live.rdd.getNumPartitions()
            while len(since) < min(STORE, rounds - (done - first)):
                since.append(grow(_passes(live, tasks, since, edges, bits), done + len(since), p, edges, bits))
        finally:
            live.unpersist()
        rows = materialize(rows.select(*[c.split()[0] for c in ROWS.split(", ")]).mapInArrow(_advance_pass(since, len(names), p, done + len(since)), ROWS + ", errors array<double>"), "boosted", compression="zstd")
        sums = {r["side"]: r for r in rows.groupBy("side").agg(F.sum("n").alias("n"), *[F.sum(F.col("errors")[i]).alias(f"e{i}") for i in range(len(since))]).collect()}
        for i in range(len(since)):
            rmse = [math.sqrt(sums[s][f"e{i}"] / sums[s]["n"]) if s in sums else None for s in (0, 1)]
            curve.append((done + i, *rmse))
        trees += since
        done += len(since)
        if patience is not None and 1 in sums:
            best = min((v, r) for r, _, v in curve)
            stop = [r for r, _, v in curve if r - min((w, q) for q, _, w in curve if q <= r)[1] >= patience]
            if stop:
                curve = [c for c in curve if c[0] <= stop[0]]
                best = min((v, r) for r, _, v in curve)
                break
    if patience is not None and best[1] >= 0:
        trees = trees[: best[1] + 1]
    return Booster(names, p, model.base, trees), curve


# -- the stored model and its scoring ------------------------------------------

def save(model: Booster, spark: SparkSession, path: str) -> str:
    """Write the model: a table of nodes and one row with features and parameters."""
    spark.createDataFrame(model.rows(), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    about = json.dumps({"features": model.features, "params": model.params, "base": model.base})
    spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")
    return path


def nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/nodes")


def load(spark: SparkSession, path: str) -> Booster:
    about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
    trees: dict[int, Tree] = {}
    for r in nodes(spark, path).filter("treeID > 0").collect():                # trees x nodes, no data
        t = trees.setdefault(r["treeID"], Tree(about["params"]["max_depth"]))
        i = r["id"]
        t.feature[i], t.threshold[i], t.missing_left[i] = r["featureIndex"], r["threshold"] if r["threshold"] is not None else 0.0, r["missing_left"]
        t.value[i], t.gain[i], t.cover[i] = r["prediction"], r["gain"], r["rawCount"]
    return Booster(about["features"], about["params"], about["base"], [trees[k] for k in sorted(trees)])


def score_column(model: Booster, x: Column) -> Column:
    """The model's output for an array column of features, as a Catalyst expression: every tree is
    walked from its root through arrays of its nodes."""
    n = [len(t.feature) for t in model.trees]
    root = np.concatenate([[0], np.cumsum(n)]).astype(int)
    if not model.trees:
        return F.lit(model.base)
    flat = lambda name: np.concatenate([getattr(t, name) for t in model.trees])
    feature, local = flat("feature"), np.concatenate([np.arange(k) for k in n])
    start = np.repeat(root[:-1], n)
    lists = {"f": [int(v) for v in feature], "t": [float(v) for v in flat("threshold")], "m": [bool(v) for v in flat("missing_left")],
             "l": [int(v) for v in start + 2 * local + 1], "v": [float(v) for v in flat("value")]}
    held = {k: F.lit(v) for k, v in lists.items()}
    depth = max(t.depth for t in model.trees)

    def step(at: Column, _: Column) -> Column:
        f = F.get(held["f"], at)
        v = F.get(x, f)
        left = F.when(v.isNull() | F.isnan(v), F.get(held["m"], at)).otherwise(v <= F.get(held["t"], at))
        return F.when(f < 0, at).otherwise(F.get(held["l"], at) + F.when(left, 0).otherwise(1))

    def leaf(first: Column) -> Column:
        return F.get(held["v"], F.aggregate(F.lit(list(range(depth))), first, step))
    return F.aggregate(F.lit([int(r) for r in root[:-1]]), F.lit(float(model.base)), lambda total, first: total + leaf(first))


def _score_task(model: Booster) -> Callable[..., pa.Array]:
    """The model's output for columns of features: they become bins between the model's cuts once, and every tree is walked by table."""
    cuts = [np.unique([c for t in model.trees for c in t.threshold[t.feature == f] if c < math.inf]) for f in range(len(model.features))]
    for t in model.trees:
        for i in np.flatnonzero(t.feature >= 0):
            t.cut[i] = np.searchsorted(cuts[t.feature[i]], t.threshold[i])

    def run(*columns: pa.Array) -> pa.Array:
        bins = np.empty((len(columns), len(columns[0])), np.uint8)
        for f, c in enumerate(columns):
            x = c.to_numpy(zero_copy_only=False).astype(np.float64)
            bins[f] = np.where(np.isnan(x), MISSING, np.searchsorted(cuts[f], x))
        out = np.full(bins.shape[1], model.base)
        for t in model.trees:
            out += t.value.take(t.node_of(bins))
        return pa.array(out)
    return run


def score(spark: SparkSession, path: str, df: DataFrame, out: str = "prediction") -> DataFrame:
    """``df`` with the stored model's output; batch and stream alike."""
    model = load(spark, path)
    x = F.array(*[F.col(c).cast("double") for c in model.features])
    return df.withColumn("_features", x).withColumn(out, score_column(model, F.col("_features"))).drop("_features")


def score_table(spark: SparkSession, path: str, df: DataFrame, out: str = "prediction") -> DataFrame:
    """``score`` of a batch, in numpy: the same numbers."""
    model = load(spark, path)
    if any(len(np.unique(np.concatenate([t.threshold[t.feature == f] for t in model.trees]))) >= MISSING for f in range(len(model.features)) if model.trees):
        return score(spark, path, df, out)                                       # more cuts than a byte holds
    task = _score_task(model)

    @F.arrow_udf("double")
    def predicted(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return (task(*c) for c in columns)
    return df.withColumn(out, predicted(*[F.col(c).cast("double") for c in model.features]))

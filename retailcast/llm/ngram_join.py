"""N-gram Jaccard join with count vectors in R-trees.

A document's distinct 5-word shingles are hashed into GROUPS groups; the group
counts are a point. For two sets the overlap is at most the sum of the
coordinate minima, and for a point and a box at most the sum of
min(point, upper corner); what survives is verified on the shingle sets.

Boxes over unrelated documents are wide in every coordinate, so one tree over
a whole corpus would visit every leaf. Spark therefore first brings together
the documents that can link, and the trees work inside those blocks:

1. Equal sets become one node (grouped, map-side combined).
2. Likely near copies: nodes with an equal min-hash meet in blocks of bounded
   size around a common centre; an R-tree join inside each block finds links.
   This contracts large groups of near copies to one label in linear work.
3. Exactness: in any fixed order of all shingles, two sets that link share at
   least l shingles among the first n - ceil(0.75 n) + l of either (prefix
   filter); l is 1 + n / STRIDE, so sharing a passage isn't enough. The order puts
   frequent shingles last. Nodes of different labels that share enough keys and
   pass the size and count-vector bounds are verified.
4. Connected components of all links.

Keys are split into tiles when many nodes meet under one, so no task holds an
unbounded group; nothing is dropped. Only a list of at most HEAVY_MAX frequent
shingle hashes and bit tables of fixed size go through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm import textvec as V
from retailcast.llm.graph import components
from retailcast.session import materialize

K = 5
#: Similarity threshold as a fraction.
NUM, DEN = 3, 4
GROUP_BITS = 7
GROUPS = 1 << GROUP_BITS
GROUP_SHIFT = V.U(64 - GROUP_BITS)
HEAVY_MAX = 200_000
#: Shingles counted together in a task, and the count there from which one is reported.
HEAVY_CHUNK, HEAVY_MIN = 2_000_000, 8
#: Most members of a min-hash block, and of a tile of a key.
BLOCK, TILE = 512, 512
#: Keys with at most so many nodes give pairs directly, others go to R-trees.
SMALL_RUN = 24
LEAF = 32
#: Shingles compared at once when a tile is verified.
COLUMNS = 4096
HOMES = 5
#: One more shared key is asked for, and one more is listed, for so many shingles.
STRIDE = 20


def need(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Least overlap of sets of n and m elements at which they link: i*(DEN+NUM) >= NUM*(n+m)."""
    return -((-NUM * (n + m)) // (NUM + DEN))


def sizes_fit(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (DEN * np.minimum(n, m) >= NUM * np.maximum(n, m))


# ---- R-tree over count vectors ------------------------------------------------------------

class CountTree:
    """A packed two-level R-tree: leaves of LEAF points sorted by size and then by
    the widest coordinate of each size band; per leaf the upper corner and least size."""

    def __init__(self, counts: np.ndarray, n: np.ndarray):
        order = np.argsort(n, kind="stable")
        band = LEAF * 8
        for a in range(0, len(order), band):
            own = order[a:a + band]
            widest = int(np.argmax(np.ptp(counts[own], axis=0)))
            order[a:a + band] = own[np.argsort(counts[own, widest], kind="stable")]
        self.order, self.counts, self.n = order, counts[order], n[order]
        cuts = np.arange(0, len(order), LEAF)
        self.cuts = np.append(cuts, len(order))
        self.upper = np.maximum.reduceat(self.counts, cuts, axis=0)
        self.least, self.most = np.minimum.reduceat(self.n, cuts), np.maximum.reduceat(self.n, cuts)

    def near(self, point: np.ndarray, n: int) -> np.ndarray:
        """Indices of all points whose bounds allow a link with the given one."""
        leaf = np.minimum(self.upper, point).sum(axis=1) >= need(self.least, n)
        leaf &= (DEN * n >= NUM * self.least) & (DEN * self.most >= NUM * n)
        hits = [np.arange(self.cuts[i], self.cuts[i + 1]) for i in np.flatnonzero(leaf)]
        if not hits:
            return np.zeros(0, np.int64)
        at = np.concatenate(hits)
        keep = sizes_fit(self.n[at], n)
        keep &= np.minimum(self.counts[at], point).sum(axis=1) >= need(self.n[at], n)
        return self.order[at[keep]]


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact verification on two sorted sets."""
    if not len(a) or not len(b):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return (NUM + DEN) * int(np.count_nonzero(b[at] == a)) >= NUM * (len(a) + len(b))


def tile_links(sets: list[np.ndarray], labels: np.ndarray) -> list[tuple[int, int]]:
    """Verified links that connect whatever is linked within a tile, from exact
    overlaps: products of 0/1 matrices over the shingles that two members share."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    values, which = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.repeat(np.arange(len(sets)), n)
    shared = np.bincount(which, minlength=len(values))[which] > 1
    _, which = np.unique(which[shared], return_inverse=True)
    member = member[shared]
    order = np.argsort(which, kind="stable")
    which, member = which[order], member[order]
    overlap = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, COLUMNS):
        a, b = np.searchsorted(which, [lo, lo + COLUMNS])
        x = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        x[member[a:b], which[a:b] - lo] = 1
        overlap += x @ x.T
    i, j = np.nonzero(np.triu(overlap >= need(n[:, None], n[None, :]), 1) & (labels[:, None] != labels[None, :]))
    first, known, out = {}, Union(len(sets)), []
    for k, v in enumerate(labels.tolist()):
        known.join(k, first.setdefault(v, k))
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        if known.join(a, b):
            out.append((a, b))
    return out


def block_links(sets: list[np.ndarray], labels: np.ndarray) -> list[tuple[int, int]]:
    """Verified links that connect whatever is linked within a block; members
    with one label count as connected already. The first member is the centre."""
    n = np.array([len(s) for s in sets])
    counts = np.zeros((len(sets), GROUPS), dtype=np.int32)
    for i, s in enumerate(sets):
        counts[i] = np.bincount((s >> GROUP_SHIFT).astype(np.int64), minlength=GROUPS)
    tree, known = CountTree(counts, n), Union(len(sets))
    first = {}
    for i, x in enumerate(labels):
        known.join(i, first.setdefault(x, i))
    out = []
    for i in range(len(sets)):
        for j in np.sort(tree.near(counts[i], n[i])):
            if j > i and known.find(i) != known.find(int(j)) and linked(sets[i], sets[j]):
                known.join(i, int(j))
                out.append((i, int(j)))
    return out


# ---- per-document passes ----------------------------------------------------------------------

@V.frugal
def _heavy_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush():
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= HEAVY_MIN
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(V.signed(values[often])), pa.array(counts[often])], ["h", "c"])

    for batch in batches:
        for _, w in V.word_blocks(batch.column(0)):
            grams, rows, _ = V.gram_hashes(w, K)
            held.append(V.distinct_per_row(grams, rows, w.rows)[0])
            if sum(map(len, held)) >= HEAVY_CHUNK:
                yield flush()
    if held:
        yield flush()


def heavy_shingles(docs: DataFrame, text: str) -> np.ndarray:
    """Frequent shingle hashes, rarest first; at most HEAVY_MAX.

    Each task reports what occurs HEAVY_MIN times among the shingles it counts
    together; the most frequent of these by summed count are listed. The list
    only orders keys: any list gives the same links.
    """
    seen = materialize(docs.select(text).mapInArrow(_heavy_pass, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "heavy")
    steps = sorted((r[0], r[1]) for r in seen.groupBy(F.floor(F.log2("c") * 4).alias("s")).count().collect())
    total, cut = 0, None
    for step, count in reversed(steps):
        if total + count > HEAVY_MAX:
            break
        total, cut = total + count, step
    if cut is None:
        return np.zeros(0, V.U)
    rows = seen.filter(F.floor(F.log2("c") * 4) >= cut).toArrow()
    h, c = rows.column("h").to_numpy(), rows.column("c").to_numpy()
    return h[np.lexsort((h, c))].view(V.U)


def _home(values: np.ndarray, offsets: np.ndarray, turn: int) -> np.ndarray:
    x = V.mix(values + V.U(turn)) if turn else values
    return np.minimum.reduceat(x, offsets[:-1]) if len(offsets) > 1 else x


SIGNED = "doc_id long, n long, f1 long, f2 long, homes array<long>, counts binary, prefix array<long>"


def _signature_pass(heavy: np.ndarray):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = V.HashSet(heavy)
        rank = np.empty(len(heavy), dtype=np.int64)
        rank[np.searchsorted(table.values, heavy)] = np.arange(len(heavy))
        for batch in batches:
            ids = batch.column(0)
            for first, w in V.word_blocks(batch.column(1)):
                grams, rows, _ = V.gram_hashes(w, K)
                values, off = V.distinct_per_row(grams, rows, w.rows)
                n = np.diff(off)
                full = np.flatnonzero(n > 0)
                f1, f2 = np.zeros(w.rows, dtype=V.U), np.zeros(w.rows, dtype=V.U)
                homes = np.zeros((w.rows, HOMES), dtype=V.U)
                if len(full):
                    bounds = np.append(off[full], off[-1])
                    with np.errstate(over="ignore"):
                        f1[full] = V.mix(np.add.reduceat(V.mix(values + V.U(101)), bounds[:-1]) + n[full].astype(V.U))
                        f2[full] = V.mix(np.add.reduceat(V.mix(values + V.U(211)), bounds[:-1]) + n[full].astype(V.U))
                    for t in range(HOMES):
                        homes[full, t] = _home(values, bounds, t)
                counts = np.bincount(np.repeat(np.arange(w.rows), n) * GROUPS + (values >> GROUP_SHIFT).astype(np.int64),
                                     minlength=w.rows * GROUPS).astype(np.uint32).reshape(w.rows, GROUPS)
                at, which = table.index(values)
                late = np.full(len(values), -1, dtype=np.int64)
                late[at] = rank[which]
                prefix = []
                for r in range(w.rows):
                    own, l = values[off[r]:off[r + 1]], late[off[r]:off[r + 1]]
                    size = n[r] - -(-NUM * n[r] // DEN) + 1 + n[r] // STRIDE if n[r] else 0
                    front = own[l < 0]
                    if len(front) < size:
                        front = np.concatenate([front, own[np.argsort(l, kind="stable")][len(front):]])
                    prefix.append(front[:size])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)),
                    pa.array(V.signed(np.concatenate(prefix)) if prefix else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, w.rows), pa.array(n), pa.array(V.signed(f1)), pa.array(V.signed(f2)),
                     pa.ListArray.from_arrays(pa.array(np.arange(w.rows + 1, dtype=np.int32) * HOMES),
                                              pa.array(V.signed(homes.ravel()))),
                     pa.array([c.tobytes() for c in counts], pa.binary()), lists],
                    ["doc_id", "n", "f1", "f2", "homes", "counts", "prefix"])
    return run


def _set_pass(words: np.ndarray):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = V.in_bitmap(words, batch.column(2).to_numpy())
            part = batch.filter(pa.array(keep))
            for first, w in V.word_blocks(part.column(1)):
                grams, rows, _ = V.gram_hashes(w, K)
                values, off = V.distinct_per_row(grams, rows, w.rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(first, w.rows),
                     pa.array([values[off[r]:off[r + 1]].tobytes() for r in range(w.rows)], pa.binary())], ["node", "set"])
    return run


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set): the shingle sets of the documents that stand for ``nodes``."""
    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - V.ID_BITS)
    found = docs.select("doc_id", "text", slot.alias("slot")).mapInArrow(
        _set_pass(V.id_bitmap(nodes.select("node").distinct())), "node long, set binary")
    return nodes.join(found, "node")


@V.frugal
def _link_pass(verify, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block, the centre first -> links."""
    a, b = [], []
    for t in V.key_runs(batches, "block", "salt"):
        node = t.column("node").to_numpy()
        order = np.lexsort((node, t.column("rank").to_numpy()))
        raw = t.column("set").to_pylist()
        sets = [np.frombuffer(raw[i], dtype=V.U) for i in order]
        node, label = node[order], t.column("label").to_numpy()[order]
        for i, j in verify(sets, label):
            a.append(node[i])
            b.append(node[j])
    yield pa.RecordBatch.from_arrays([pa.array(np.array(a, dtype=np.int64)), pa.array(np.array(b, dtype=np.int64))], ["a", "b"])


def _block_join(docs: DataFrame, members: DataFrame, verify=block_links) -> DataFrame:
    """``members`` (block, salt, rank, node, label) -> verified links (a, b)."""
    rows = _sets(docs, members)
    return (rows.repartition("block", "salt").sortWithinPartitions("block", "salt")
            .mapInArrow(partial(_link_pass, verify), "a long, b long"))


def _home_members(nodes: DataFrame, turns: list[int]) -> DataFrame:
    """Block members: nodes of more than one label with an equal min-hash, in
    salted blocks that all hold the centre (the least node)."""
    homes = nodes.select("node", "label", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("homes")[t].alias("h")) for t in turns])).alias("x")) \
        .select("node", "label", F.xxhash64("x.t", "x.h").alias("block"))
    groups = (homes.groupBy("block").agg(F.count("*").alias("c"), F.min(F.struct("node", "label")).alias("centre"),
                                         F.min("label").alias("lo"), F.max("label").alias("hi"))
              .filter("lo <> hi").withColumn("salts", F.ceil(F.col("c") / BLOCK).cast("int")).drop("lo", "hi", "c"))
    rest = homes.join(groups, "block").filter("node <> centre.node").select(
        "block", F.pmod(F.xxhash64("node"), "salts").cast("long").alias("salt"), F.lit(1).alias("rank"), "node", "label")
    centres = groups.select("block", F.explode(F.expr("sequence(0L, cast(salts - 1 AS BIGINT))")).alias("salt"),
                            F.lit(0).alias("rank"), "centre.node", "centre.label")
    return rest.unionByName(centres)


# ---- keys -----------------------------------------------------------------------------------------

RUNS = "kind int, a long, b long, n long, label long"


@V.frugal
def _run_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, n, label) sorted by key -> kind 0: pairs (a, b) of nodes of
    different labels and fitting sizes that share n keys held by few nodes;
    kind 1: the nodes b of families a of other keys; kind 2: of a node (a) the
    numbers of keys that nodes of several labels (n) and of these many nodes (b) hold."""
    carry: dict | None = None
    for last, batch in _with_last(batches):
        cols = {c: batch.column(c).to_numpy() for c in ("key", "node", "n", "label")}
        if carry is not None:
            cols = {c: np.concatenate([carry[c], cols[c]]) for c in cols}
        key = cols["key"]
        if not len(key):
            continue
        end = len(key) if last else int(np.searchsorted(key, key[-1]))
        carry = None if last else {c: x[end:] for c, x in cols.items()}
        yield from _runs({c: x[:end] for c, x in cols.items()})


def _with_last(batches):
    held = None
    for b in batches:
        if held is not None:
            yield False, held
        held = b
    if held is not None:
        yield True, held


def _runs(c: dict) -> Iterator[pa.RecordBatch]:
    key, node, n, label = c["key"], c["node"], c["n"], c["label"]
    if not len(key):
        return
    cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    size = np.diff(np.append(cuts, len(key)))
    mixed = np.minimum.reduceat(label, cuts) != np.maximum.reduceat(label, cuts)
    out, pairs = [], []
    small = mixed & (size <= SMALL_RUN)
    rows = np.flatnonzero(np.repeat(small, size))
    held = np.repeat(mixed, size)
    own, which = np.unique(node[held], return_inverse=True)
    if len(own):
        out.append((2, own, np.bincount(which, weights=np.repeat(~small, size)[held]).astype(np.int64), np.bincount(which), 0))
    run = np.repeat(np.arange(len(cuts)), size)
    for step in range(1, SMALL_RUN):
        ok = rows[rows + step < len(key)]
        i = ok[run[ok + step] == run[ok]]
        if not len(i):
            break
        j = i + step
        fit = (label[i] != label[j]) & sizes_fit(n[i], n[j])
        pairs.append(np.stack([np.minimum(node[i[fit]], node[j[fit]]), np.maximum(node[i[fit]], node[j[fit]])], axis=1))
    if pairs:
        both = np.concatenate(pairs)
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        new = np.flatnonzero(np.append(True, (both[1:] != both[:-1]).any(axis=1))[: len(both)])
        out.append((0, both[new, 0], both[new, 1], np.diff(np.append(new, len(both))), 0))
    large = np.repeat(mixed & (size > SMALL_RUN), size)
    if large.any():
        # keys that hold about the same nodes get the same family: their least node by hash
        h = V.mix(node.astype(V.U))
        least = np.minimum.reduceat(h, cuts)[run]
        family = np.maximum.reduceat(np.where(h == least, node, np.iinfo(np.int64).min), cuts)[run]
        both = np.unique(np.stack([family[large], node[large], n[large], label[large]]), axis=1)
        out.append((1, both[0], both[1], both[2], both[3]))
    for kind, a, b, n_, label_ in out:
        k = len(a)
        fill = lambda v: pa.array(np.broadcast_to(np.asarray(v, dtype=np.int64), k))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(k, kind, dtype=np.int32)), pa.array(a), pa.array(b), fill(n_), fill(label_)],
                                         ["kind", "a", "b", "n", "label"])


@V.frugal
def _tile_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tile members with count vectors -> candidate pairs of different labels, by R-tree."""
    for t in V.key_runs(batches, "tile"):
        node, n, label = (t.column(c).to_numpy() for c in ("b", "n", "label"))
        counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), dtype=np.uint32).reshape(-1, GROUPS).astype(np.int32)
        tree, a, b = CountTree(counts, n), [], []
        for i in range(len(node)):
            j = tree.near(counts[i], n[i])
            j = j[(node[j] > node[i]) & (label[j] != label[i])]
            a.append(np.full(len(j), node[i]))
            b.append(node[j])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


@V.frugal
def _bound_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that the sum of coordinate minima lets through."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(-1, GROUPS) for c in ("ca", "cb"))
        keep = np.minimum(x, y).sum(axis=1, dtype=np.int64) >= need(x.sum(axis=1, dtype=np.int64), y.sum(axis=1, dtype=np.int64))
        part = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])


def _tiled(family: DataFrame) -> DataFrame:
    """Members of families (a, b, n, label) with the tiles they are compared in.

    Sizes that can link are in the same or neighbouring bands of ratio 4:3. A band of
    a family is cut into chunks of TILE / 2; a tile holds two chunks of one or of
    neighbouring bands, or a whole family that fits.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(DEN / NUM)))).cast("int")
    rows = family.withColumn("band", band)
    chunks = (rows.groupBy("a", "band").agg(F.count("*").alias("k"))
              .groupBy("a").agg(F.sum("k").alias("total"), F.map_from_entries(F.collect_list(F.struct("band", F.ceil(2 * F.col("k") / TILE).cast("int").alias("c")))).alias("chunks")))
    count = lambda d: F.coalesce(F.col("chunks")[F.col("band") + d], F.lit(0))
    own = F.pmod(F.xxhash64("b"), count(0)).cast("int")
    upto = lambda c: F.when(c > 0, F.sequence(F.lit(0), F.greatest(c, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    tile = lambda i, x, j, y: F.xxhash64("a", i, x, j, y)
    all_tiles = F.concat(
        F.transform(upto(count(0)), lambda y: tile("band", F.least(own, y), "band", F.greatest(own, y))),
        F.transform(upto(count(1)), lambda y: tile("band", own, F.col("band") + 1, y)),
        F.transform(upto(count(-1)), lambda y: tile(F.col("band") - 1, y, "band", own)))
    return (rows.join(chunks, "a").withColumn("tile", F.explode(F.when(F.col("total") <= TILE, F.array(F.xxhash64("a"))).otherwise(all_tiles)))
            .select("a", "b", "n", "label", "tile"))


def _candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (a < b) of nodes of different labels that share a prefix key and pass the bounds."""
    spark = nodes.sparkSession
    keys = nodes.select(F.explode("prefix").alias("key"), "node", "n", "label")
    runs = materialize(keys.repartition("key").sortWithinPartitions("key").mapInArrow(_run_pass, RUNS), "runs")
    counts = nodes.select("node", "counts")
    asked = lambda c: F.lit(1) + F.floor(F.col(c) / STRIDE)
    # a node of n shingles can link only with nodes of 0.75 n or more, and needs as many shared keys as they do
    held = (runs.filter("kind = 2").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("mixed"), F.sum("b").alias("large"))
            .join(nodes.select("node", "n"), "node").filter(F.col("mixed") >= 1 + F.floor(F.floor(F.col("n") * NUM / DEN) / STRIDE)))
    held = materialize(held.select("node", "n", "large"), "held")

    def enough(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b, c: shared keys among those of few nodes) that can share enough keys in all."""
        return (pairs.join(held.toDF("a", "na", "la"), "a").join(held.toDF("b", "nb", "lb"), "b")
                .filter(F.col("c") + F.least("la", "lb") >= F.least(asked("na"), asked("nb"))).select("a", "b"))

    shared = runs.filter("kind = 0").groupBy("a", "b").agg(F.sum("n").alias("c"))
    small = (enough(shared).join(counts.toDF("a", "ca"), "a").join(counts.toDF("b", "cb"), "b")
             .mapInArrow(_bound_pass, "a long, b long"))
    family = runs.filter("kind = 1").select("a", "b", "n", "label").distinct().join(held.select(F.col("node").alias("b")), "b")
    tiles = (_tiled(materialize(family, "family")).join(counts.toDF("b", "counts"), "b").select("tile", "b", "n", "label", "counts")
             .repartition("tile").sortWithinPartitions("tile").mapInArrow(_tile_pass, "a long, b long").distinct())
    tiled = enough(tiles.join(shared, ["a", "b"], "left").fillna(0, ["c"]))
    return materialize(small.unionByName(tiled).distinct(), "pairs")


def _pair_members(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Tiles for verification: a pair goes to the block of the least node that either
    end is a candidate with, so a node's set is sent once per block and not per pair.
    A block of more than BLOCK nodes is cut into chunks, and its pairs into tiles of two."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    placed = materialize(pairs.join(least, "a").join(least.toDF("b", "mb"), "b").select("a", "b", F.least("m", "mb").alias("block")), "placed")
    chunks = (placed.select("block", F.explode(F.array("a", "b")).alias("node")).distinct()
              .groupBy("block").agg(F.ceil(2 * F.count("*") / BLOCK).alias("chunks")))
    chunks = materialize(chunks, "chunks")              # plain tables on both sides: the join can split a block of many pairs
    chunk = lambda c: F.pmod(F.xxhash64(c), "chunks")
    tiled = placed.join(chunks, "block").select("block", "a", "b", (F.least(chunk("a"), chunk("b")) * F.lit(2**31) + F.greatest(chunk("a"), chunk("b"))).alias("salt"))
    members = tiled.select("block", "salt", F.explode(F.array("a", "b")).alias("node")).distinct()
    return members.withColumn("rank", F.lit(1)).join(labels, "node").select("block", "salt", "rank", "node", "label")


def _label(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return nodes.drop("label").join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of every row of ``docs``.

    Two documents link when their 5-word shingle sets have Jaccard similarity
    of 0.75 or more; ``component_id`` is the least id reachable by links,
    ``class_id`` the least id with an equal set. Null or blank texts have an
    empty set and are their own component. Rows with a null id keep their
    ``n_shingles`` and have null ids. Repeated rows are returned as often as
    they come; rows of one id with different texts count as one document
    where that id stands for their sets. Other columns are ignored. An empty table
    gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    heavy = heavy_shingles(docs, "text")
    signed = materialize(docs.mapInArrow(_signature_pass(heavy), SIGNED), "signed")
    named = signed.filter("doc_id is not null and n > 0")
    nodes = materialize(named.groupBy("f1", "f2", "n").agg(F.min_by(F.struct("doc_id", "homes", "counts", "prefix"), "doc_id").alias("x"))
                        .select("f1", "f2", "n", F.col("x.doc_id").alias("node"), F.col("x.doc_id").alias("label"), "x.homes", "x.counts", "x.prefix"), "nodes")
    light = nodes.select("node", "label", "homes")
    links = materialize(_block_join(docs, _home_members(light, [0])), "links")
    light = materialize(_label(light, links), "labels")
    more = materialize(_block_join(docs, _home_members(light, list(range(1, HOMES)))), "links")
    links = links.unionByName(more)
    labels = materialize(_label(light, links).select("node", "label"), "labels")
    pairs = _candidates(nodes.drop("label", "homes").join(labels, "node"))
    links = links.unionByName(materialize(_block_join(docs, _pair_members(pairs, labels), tile_links), "links"))
    found = _label(nodes.select("node"), links)
    classes = nodes.select("f1", "f2", "n", "node").join(found, "node")
    return (signed.select("doc_id", "n", "f1", "f2")
            .join(classes.select("f1", "f2", "n", "node", "label"), ["f1", "f2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")).alias("class_id")))

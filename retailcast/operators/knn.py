"""Exact k-nearest-neighbour join over the cells of a k-d tree.

A tree of median cuts, made on the driver from a bounded sample of the candidates, gives
cells of about CHUNK rows, so their number grows with the rows; Spark takes each cell's row count and the
box around its rows. A query first searches its own cell (the nearest ones until k
candidates are held); the k-th distance found there bounds the answer, and of the other cells it
visits those whose box is within that distance. Cells are searched tile by tile: at most
about CHUNK candidates, under a small tree of their own, against a stream of queries; a cell
that holds a third of all rows is spread over many tasks, and no list of pairs is ever made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.session import materialize

#: Candidates and queries of a tile, queries searched together, rows of a leaf inside a tile.
CHUNK, BLOCK, STEP, LEAF = 16_384, 32_768, 8_192, 64
#: Sampled rows of a cell, sampled rows at most (the driver holds them), shipped rows of a partition.
SAMPLED, SAMPLE, ROWS = 32, 131_072, 200_000


def scaled_features(df: DataFrame, features: Sequence[str], id_col: str, steps: int = 1_000, out: str = "x") -> DataFrame:
    """``df`` with ``out``: each feature scaled by its range over ``df`` to whole numbers from 0 to
    ``steps`` (a NULL counts as 0, a constant column is 0), so that squared distances are exact."""
    ends = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}__{name}") for c in features for name, f in (("lo", F.min), ("hi", F.max))]).first()
    cols = []
    for c in features:
        a, b = ends[f"{c}__lo"], ends[f"{c}__hi"]
        if a is None or a == b:
            cols.append(F.lit(0.0))
        else:
            v = F.floor(F.lit(float(steps)) * (F.col(c).cast("double") - F.lit(a)) / (F.lit(b) - F.lit(a))).cast("double")
            cols.append(F.coalesce(v, F.lit(0.0)))
    return df.withColumn(out, F.array(*cols))


def _matrix(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False)
    return x.reshape(len(column), -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances; exact for whole numbers."""
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :], 0)


class Tree:
    """Median cuts of the dimension with the greatest variance; a leaf has at most ``size`` points or equal ones."""

    def __init__(self, points: np.ndarray, size: int):
        self.dim, self.cut, self.child, self.leaf, self.rows = [], [], [], [], []
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            at = len(self.dim)
            if parent >= 0:
                self.child[parent][side] = at
            x = points[rows]
            dim = int(x.var(axis=0).argmax())
            low, high = x[:, dim].min(), x[:, dim].max()
            self.dim.append(dim)
            self.child.append([at, at])
            if len(rows) <= size or low == high:
                self.cut.append(math.inf)
                self.leaf.append(len(self.rows))
                self.rows.append(rows)
                continue
            cut = np.partition(x[:, dim], len(rows) // 2)[len(rows) // 2]
            if cut == high:
                cut = x[x[:, dim] < high, dim].max()
            self.cut.append(cut)
            self.leaf.append(-1)
            right = x[:, dim] > cut
            todo += [(rows[right], at, 1), (rows[~right], at, 0)]
        self.dim, self.cut, self.child, self.leaf = map(np.array, (self.dim, self.cut, self.child, self.leaf))

    def boxed(self, low: np.ndarray, high: np.ndarray) -> Tree:
        """With the boxes of the leaves, from which those of the inner nodes follow (a child comes behind its parent)."""
        self.low, self.high = np.full((len(self.dim), low.shape[1]), np.inf), np.full((len(self.dim), low.shape[1]), -np.inf)
        for i in range(len(self.dim) - 1, -1, -1):
            own = self.leaf[i]
            a, b = self.child[i]
            self.low[i] = low[own] if own >= 0 else np.minimum(self.low[a], self.low[b])
            self.high[i] = high[own] if own >= 0 else np.maximum(self.high[a], self.high[b])
        return self

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf on whose side of all cuts each row is."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            node = at[rows]
            at[rows] = self.child[node, (x[rows, self.dim[node]] > self.cut[node]).astype(np.int64)]
            rows = rows[self.leaf[at[rows]] < 0]
        return self.leaf[at]

    def near(self, x: np.ndarray, limit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows that have its box within the squared distance ``limit``), which may fall meanwhile."""
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            own = x[rows]
            gap = np.maximum(np.maximum(self.low[node] - own, own - self.high[node]), 0)
            rows = rows[np.einsum("ij,ij->i", gap, gap) <= limit[rows]]
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                yield int(self.leaf[node]), rows
            else:
                todo += [(c, rows) for c in self.child[node]]


class Cells:
    """The tree over all candidates and the row counts of its cells."""

    def __init__(self, sample: np.ndarray, size: int):
        self.tree = Tree(sample, size)
        self.size, self.width = len(self.tree.rows), sample.shape[1]
        self.tree.rows = None

    def with_stats(self, rows: list) -> Cells:
        self.count = np.zeros(self.size, np.int64)
        self.low, self.high = np.full((self.size, self.width), np.inf), np.full((self.size, self.width), -np.inf)
        for r in rows:
            self.count[r["cell"]], self.low[r["cell"]], self.high[r["cell"]] = r["n"], r["low"], r["high"]
        self.tree.boxed(self.low, self.high)
        return self

    def first(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, cells): each query's own cell, or the nearest ones that hold ``k`` candidates between them."""
        own = self.tree.place(x)
        full = self.count[own] >= k
        q, cell = [np.flatnonzero(full)], [own[full]]
        for i in np.flatnonzero(~full):
            gap = np.maximum(np.maximum(self.low - x[i], x[i] - self.high), 0)
            order = np.argsort((gap * gap).sum(axis=1), kind="stable")
            order = order[self.count[order] > 0]
            order = order[:int((np.cumsum(self.count[order]) < k).sum()) + 1]
            q.append(np.full(len(order), i))
            cell.append(order)
        return np.concatenate(q), np.concatenate(cell)

    def reached(self, x: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, cells) that the first search left out and that can hold a candidate within ``limit``."""
        found = [(rows, np.full(len(rows), c)) for c, rows in self.tree.near(x, limit)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, cell = (np.concatenate(z) for z in zip(*found, strict=True))
        done_q, done_cell = self.first(x, k)
        new = ~np.isin(q * self.size + cell, done_q * self.size + done_cell)
        return q[new], cell[new]


def _assign(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.tree.place(_matrix(batch.column(1))).astype(np.int32))], ["candidate_id", "x", "cell"])
    return run


def _ship(cells: Cells, k: int, again: bool):
    """Queries (id, x, limit) with each cell they visit in the first or the second search."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                x = _matrix(part.column(1))
                q, cell = cells.reached(x, k, part.column(2).to_numpy(zero_copy_only=False)) if again else cells.first(x, k)
                for cut in range(0, len(q), STEP):
                    own = pa.array(q[cut:cut + STEP])
                    yield pa.RecordBatch.from_arrays([*[c.take(own) for c in part.columns], pa.array(cell[cut:cut + STEP].astype(np.int32))], ["query_id", "x", "limit", "cell"])
    return run


class Tile:
    """The candidates of a tile under a tree of their own."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        ids, points = ids[order], points[order]
        self.tree, self.k = Tree(points, LEAF), k
        # a larger leaf holds one point many times: ties go to the smaller id, so its first k rows stand for it
        rows = [np.sort(r) if len(r) <= max(LEAF, k) else np.sort(r)[:k] for r in self.tree.rows]
        self.leaves = [(ids[r], points[r]) for r in rows]
        self.tree.boxed(np.array([x.min(axis=0) for _, x in self.leaves]), np.array([x.max(axis=0) for _, x in self.leaves]))

    def search(self, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, candidate id, squared distance): each query's best ``k`` within its ``limit``."""
        limit = limit.copy()
        near, who = np.full((len(x), self.k), np.inf), np.zeros((len(x), self.k), np.int64)

        def look(leaf: int, rows: np.ndarray) -> None:
            ids, points = self.leaves[leaf]
            d = _squared(x[rows], points)
            some = (d <= limit[rows][:, None]).any(axis=1)
            rows, d = rows[some], d[some]
            if not len(rows):
                return
            d, c = np.concatenate([near[rows], d], axis=1), np.concatenate([who[rows], np.broadcast_to(ids, d.shape)], axis=1)
            edge = np.minimum(np.partition(d, self.k - 1, axis=1)[:, self.k - 1], limit[rows])
            q, p = np.nonzero((d <= edge[:, None]) & (d < np.inf))
            d, c = d[q, p], c[q, p]
            rank = np.lexsort((c, d, q))
            q, d, c = q[rank], d[rank], c[rank]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < self.k
            near[rows], who[rows] = np.inf, 0
            near[rows[q[keep]], place[keep]], who[rows[q[keep]], place[keep]] = d[keep], c[keep]
            limit[rows] = np.minimum(limit[rows], near[rows, self.k - 1])
        home = self.tree.place(x)
        order = np.argsort(home, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
            look(int(home[rows[0]]), rows)
        for leaf, rows in self.tree.near(x, limit):
            look(leaf, rows[home[rows] != leaf])
        q, p = np.nonzero(near < np.inf)
        return q, who[q, p], near[q, p]


TILE = ["cell", "chunk", "block"]


def _search(k: int):
    """Rows sorted by tile, candidates (kind 0) ahead of queries (kind 1): the best ``k`` of each tile and query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, ids, points, ready = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [batch.num_rows]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part, key = batch.slice(a, b - a), tuple(keys[a])
                if key[:3] != tile:
                    tile, ids, points, ready = key[:3], [], [], None
                own, x = part.column(4).to_numpy(zero_copy_only=False), _matrix(part.column(5))
                if key[3] == 0:
                    ids.append(own)
                    points.append(x)
                    continue
                if not ids:
                    continue
                if ready is None:
                    ready = Tile(np.concatenate(ids), np.concatenate(points), k)
                limit = part.column(6).to_numpy(zero_copy_only=False)
                for at in range(0, len(own), STEP):
                    q, c, d = ready.search(x[at:at + STEP], limit[at:at + STEP])
                    yield pa.RecordBatch.from_arrays([pa.array(own[at:at + STEP][q]), pa.array(c), pa.array(d)], ["query_id", "candidate_id", "distance2"])
    return run


def _per_cell(values: np.ndarray) -> Column:
    return F.element_at(F.lit([int(v) for v in values]), F.col("cell") + 1)


def _tiles(shipped: DataFrame, placed: DataFrame, cells: Cells, k: int) -> tuple[DataFrame, int, int]:
    """(best of each tile, query rows shipped, pairs in the tiles)."""
    visits = np.zeros(cells.size, np.int64)
    for r in shipped.groupBy("cell").count().collect():                 # a row per cell
        visits[r["cell"]] = r["count"]
    chunks, blocks = -(-cells.count // CHUNK), -(-visits // BLOCK)
    zero, one = F.lit(0).cast("int"), F.lit(1).cast("int")
    candidates = placed.filter(_per_cell(blocks) > 0).select(
        "cell", F.pmod(F.xxhash64("candidate_id"), _per_cell(chunks)).cast("int").alias("chunk"),
        F.explode(F.sequence(zero, (_per_cell(blocks) - 1).cast("int"))).alias("block"), zero.alias("kind"), F.col("candidate_id").alias("id"), "x", F.lit(0.0).alias("limit"))
    queries = shipped.select(
        "cell", F.explode(F.sequence(zero, (_per_cell(chunks) - 1).cast("int"))).alias("chunk"),
        F.pmod(F.xxhash64("query_id"), _per_cell(blocks)).cast("int").alias("block"), one.alias("kind"), F.col("query_id").alias("id"), "x", "limit")
    # a partition's rows, and so the memory of its sort, stay the same however many tiles there are
    rows, tiles = int((visits * chunks).sum() + (cells.count * blocks).sum()), int((chunks * blocks).sum())
    parts = max(1, -(-rows // ROWS), min(tiles, 8 * placed.sparkSession.sparkContext.defaultParallelism))
    dealt = candidates.unionByName(queries).repartition(parts, *TILE).sortWithinPartitions(*TILE, "kind").select(*TILE, "kind", "id", "x", "limit")
    return dealt.mapInArrow(_search(k), "query_id long, candidate_id long, distance2 double"), int((visits * chunks).sum()), int((visits * cells.count).sum())


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("distance2", "candidate_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_join(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "record_id", vector_col: str = "x") -> tuple[DataFrame, dict]:
    """((query_id, rank, candidate_id, distance2), work): for each query its ``k`` nearest candidates by
    squared Euclidean distance, ties to the smaller id; all of them where there are fewer.

    Vectors are arrays of whole numbers of one length; ids are unique on each side, and rows
    without one take no part. ``work``: query rows shipped, pairs in the tiles searched (their trees skip most), pairs in all.
    """
    q = materialize(queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).alias("x")).filter("query_id IS NOT NULL"), "knn_queries")
    c = materialize(candidates.select(F.col(id_col).cast("long").alias("candidate_id"), F.col(vector_col).alias("x")).filter("candidate_id IS NOT NULL"), "knn_candidates")
    n, n_q = c.count(), q.count()
    if not n or not n_q or k < 1:
        return q.sparkSession.createDataFrame([], "query_id long, rank int, candidate_id long, distance2 double"), {"shipped": 0, "pairs": 0, "all_pairs": n * n_q}
    size = max(1, min(CHUNK * 3 // 4, max(math.isqrt(n), n // 64)))                 # rows a cell is to hold
    m = min(n, SAMPLE, max(2_048, SAMPLED * n // size))
    sample = _matrix(c.orderBy(F.xxhash64("candidate_id"), "candidate_id").limit(m).select("x").toArrow().column(0).combine_chunks())
    cells = Cells(sample, max(1, size * m // n))
    placed = materialize(c.mapInArrow(_assign(cells), "candidate_id long, x array<double>, cell int"), "knn_cells")
    ends = [F.array(*[f(F.col("x")[i]) for i in range(cells.width)]).alias(name) for name, f in (("low", F.min), ("high", F.max))]
    cells.with_stats(placed.groupBy("cell").agg(F.count("*").alias("n"), *ends).collect())
    shipped = "query_id long, x array<double>, limit double, cell int"
    near, rows, pairs = _tiles(materialize(q.withColumn("limit", F.lit(float("inf"))).mapInArrow(_ship(cells, k, False), shipped), "knn_first"), placed, cells, k)
    near = materialize(_best(near, k), "knn_near")
    limit = near.groupBy("query_id").agg(F.when(F.max("rank") == min(k, n), F.max("distance2")).otherwise(F.lit(float("inf"))).alias("limit"))
    far, more_rows, more_pairs = _tiles(materialize(q.join(limit, "query_id").select("query_id", "x", "limit").mapInArrow(_ship(cells, k, True), shipped), "knn_second"), placed, cells, k)
    found = _best(near.drop("rank").unionByName(far), k)
    return found.select("query_id", "rank", "candidate_id", "distance2"), {"shipped": rows + more_rows, "pairs": pairs + more_pairs, "all_pairs": n * n_q}

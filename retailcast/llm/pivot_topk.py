"""Exact top-k inner products by pivot-table elimination.

Distances to PIVOTS pivot vectors are computed once for every vector. For a
query q and a vector v the largest |d(q, p) - d(v, p)| is a lower bound of their
distance, hence (|q|^2 + |v|^2 - bound^2) / 2 an upper bound of their inner
product. Each task goes through its vectors block by block, evaluates them in
the order of their bounds and stops where the bound falls below the query's k-th
best score. The tasks' winners are merged by query.

Queries are a stated set: they are taken in blocks of at most QUERY_BLOCK, one
pass over the vectors each, so what is broadcast has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm import textvec as V

PIVOTS, QUERY_BLOCK, VECTOR_BLOCK, STEP = 24, 2_048, 4_096, 256
SCALE = 256.0


def vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """(ids, integer vectors) of the usable rows of (id, array) columns."""
    ids, rows = [], []
    for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        if i is None or not v.is_valid or v.values.null_count:
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all():
            ids.append(i)
            rows.append(np.floor(SCALE * x))
    return np.array(ids, dtype=np.int64), rows


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: doubles while they hold all integers that can arise."""
    most = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(a.shape[-1], 1)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Search:
    """Best rows of one block of queries of one dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.pivots = x[np.linspace(0, len(x) - 1, min(PIVOTS, len(x))).astype(int)]
        self.square = (x * x).sum(axis=1)
        self.table = self.distances(x, self.square)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]      # (scores, vector ids)

    def distances(self, v: np.ndarray, square: np.ndarray) -> np.ndarray:
        p = (self.pivots * self.pivots).sum(axis=1)
        return np.sqrt(np.maximum(square[:, None] + p[None, :] - 2 * (v @ self.pivots.T), 0))

    def add(self, ids: np.ndarray, v: np.ndarray) -> None:
        square = (v * v).sum(axis=1)
        table = self.distances(v, square)
        far = np.zeros((len(self.x), len(v)))
        for p in range(table.shape[1]):
            np.maximum(far, np.abs(self.table[:, p, None] - table[None, :, p]), out=far)
        total = self.square[:, None] + square[None, :]
        bound = (total - far * far) / 2 + 1 + 1e-9 * total          # rounding of the square roots
        for q in range(len(self.x)):
            order = np.argsort(-bound[q], kind="stable")
            for a in range(0, len(order), STEP):
                score, own = self.best[q]
                some = order[a:a + STEP]
                if len(score) == self.k:
                    some = some[bound[q, some] >= score[-1]]
                    if not len(some):
                        break
                some = some[ids[some] != self.ids[q]]
                new = products(self.x[q][None, :], v[some])[0]
                score, own = np.concatenate([score, new]), np.concatenate([own, ids[some]])
                rank = np.lexsort((own, -score))
                _, first = np.unique(own[rank], return_index=True)     # an id that came twice counts once
                rank = rank[np.sort(first)][: self.k]
                self.best[q] = score[rank], own[rank]


def _search_pass(queries: list[tuple[np.ndarray, np.ndarray]], k: int):
    @V.frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {x.shape[1]: Search(ids, x, k) for ids, x in queries}
        for batch in batches:
            for a in range(0, batch.num_rows, VECTOR_BLOCK):
                ids, rows = vectors(batch.slice(a, VECTOR_BLOCK))
                size = np.array([len(r) for r in rows])
                for dim, search in searches.items():
                    if (own := np.flatnonzero(size == dim)).size:
                        search.add(ids[own], np.stack([rows[i] for i in own]).reshape(len(own), dim))
        for s in searches.values():
            for q, (score, own) in zip(s.ids, s.best, strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), q)), pa.array(own), pa.array(score)], ["query_id", "vec_id", "score"])
    return run


def query_blocks(queries: DataFrame) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Blocks of at most QUERY_BLOCK query rows, by dimension."""
    held: list = []

    def block():
        ids, rows = vectors(pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], pa.int64()), pa.array([r[1] for r in held], pa.list_(pa.float64()))], ["i", "v"]))
        size = np.array([len(r) for r in rows])
        return [(ids[own], np.stack([rows[i] for i in own]).reshape(len(own), dim)) for dim in np.unique(size) for own in [np.flatnonzero(size == dim)]]

    for r in queries.toLocalIterator():
        held.append((r[0], r[1]))
        if len(held) == QUERY_BLOCK:
            yield block()
            held = []
    if held:
        yield block()


def top_k(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``
    its ``k`` best other rows by integer inner product, ties to the smaller id.

    Rows with a null id or with a null, null-holding or non-finite vector take no
    part; vectors of different lengths are not compared. Repeated rows count once; an id
    with several vectors has the best of their scores. Fewer than ``k`` others are all
    listed; an empty table gives none. Other columns are ignored.
    """
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    queries = rows.filter(F.col("vec_id") % every == 0)
    found = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for block in query_blocks(queries):
        if block:
            found = found.unionByName(rows.mapInArrow(_search_pass(block, k), "query_id long, vec_id long, score long"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

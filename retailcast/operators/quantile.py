"""Exact quantiles without shipping the values of a column.

Whole columns: one pass makes a KLL sketch per column, whose quantiles at the wanted rank
plus and minus its error bracket the answer; a second pass counts the values below each
bracket, and only the distinct values inside the brackets (counted per task) are shuffled to
pick the exact ranks. The counts prove that a rank lies in its bracket; otherwise the bracket is
widened and counted again.

Grouped quantiles: rows are counted per distinct value (map-side combined), the counts get an
exact distributed prefix sum in value order, and the values at the two ranks around
each quantile are picked by a grouped maximum: a task holds its range of distinct
values, never those of a whole column.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.operators.split import grouped_prefix_sum

#: Size of a sketch, and the half width of a bracket in ranks: about three times its error (2.3 / k^0.9).
SKETCH, MARGIN = 2_048, 0.006
#: Values inside all brackets up to which one window per bracket ranks them; more get a distributed prefix sum.
WINDOWED = 2_000_000


def _grouped(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: list[str]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns]))
    counts = (df.select(*by, pairs.alias("x")).select(*by, "x.feature", "x.v").filter("v IS NOT NULL")
              .groupBy(F.struct(*by, "feature").alias("g"), "v").agg(F.count(F.lit(1)).alias("c")))
    cum = grouped_prefix_sum(counts, "g", "v", ["c"])
    totals = cum.groupBy("g").agg(F.sum("c").alias("n"))
    ranked = cum.join(totals, "g")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("cum_c") - F.col("c") <= rank) & (rank < F.col("cum_c")), F.col("v")))
    picks, values = [], []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        picks += [at(F.floor(place)).alias(f"lo{i}"), at(F.ceil(place)).alias(f"hi{i}")]
        part = place - F.floor(place)
        values.append(_between(F.col(f"lo{i}"), F.col(f"hi{i}"), part))
    out = ranked.groupBy("g", "n").agg(*picks)
    return out.select(*[F.col(f"g.{c}").alias(c) for c in (*by, "feature")], "n", F.array(*values).alias("q"))


def _between(lo: Column, hi: Column, part: Column) -> Column:
    return F.when(lo == hi, lo).otherwise(lo * (1 - part) + hi * part)


def _brackets(df: DataFrame, columns: list[str], probs: list[float]) -> tuple[dict, bool]:
    """({column: (count, [(low, high)])} from sketches, whether a column holds NaN)."""
    ranks = sorted({min(max(p + s * MARGIN, 0.0), 1.0) for p in probs for s in (-1, 1)})
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(F.isnan(F.col(c).cast("double"))).alias(f"nan{i}"),
                 F.kll_sketch_agg_double(v, SKETCH).alias(f"s{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    sketches = df.agg(*aggs)
    at = F.array(*[F.lit(r) for r in ranks])
    row = sketches.select(*[x for i in range(len(columns)) for x in (
        f"n{i}", f"nan{i}", f"lo{i}", f"hi{i}", F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", at)).alias(f"q{i}"))]).first()
    out = {}
    for i, c in enumerate(columns):
        if row[f"n{i}"]:
            known = dict(zip(ranks, row[f"q{i}"], strict=True))
            ends = []
            for p in probs:
                a, b = min(max(p - MARGIN, 0.0), 1.0), min(max(p + MARGIN, 0.0), 1.0)
                ends.append((row[f"lo{i}"] if a == 0 else known[a], row[f"hi{i}"] if b == 1 else known[b]))
            out[c] = row[f"n{i}"], ends
    return out, any(row[f"nan{i}"] for i in range(len(columns)))


def _inside(ends: list[list[tuple[float, float]]]):
    """Of each column and bracket: the number of values below it (a row without a value) and the distinct values inside with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = [np.zeros(len(e), np.int64) for e in ends]
        held: list[list] = [[] for _ in ends]

        def merged(parts: list) -> list:
            if not parts:
                return []
            v, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
            return [(v, np.bincount(at, weights=np.concatenate([c for _, c in parts])).astype(np.int64))]
        for batch in batches:
            for k, e in enumerate(ends):
                column = batch.column(k).drop_null()
                v, c = np.unique(column.to_numpy(zero_copy_only=False), return_counts=True)
                total = np.concatenate([[0], np.cumsum(c)])
                keep = np.zeros(len(v), bool)
                for i, (lo, hi) in enumerate(e):
                    first, last = np.searchsorted(v, lo, "left"), np.searchsorted(v, hi, "right")
                    below[k][i] += total[first]
                    keep[first:last] = True
                held[k].append((v[keep], c[keep]))
                if len(held[k]) == 16:
                    held[k] = merged(held[k])
        for k, e in enumerate(ends):
            for v, c in merged(held[k]) or [(np.zeros(0), np.zeros(0, np.int64))]:
                for i, (lo, hi) in enumerate(e):
                    first, last = np.searchsorted(v, lo, "left"), np.searchsorted(v, hi, "right")
                    n = last - first + 1
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k, np.int32)), pa.array(np.full(n, i, np.int32)), pa.concat_arrays([pa.nulls(1, pa.float64()), pa.array(v[first:last])]),
                                                      pa.array(np.concatenate([below[k][i:i + 1], c[first:last]]))], ["k", "i", "v", "c"])
    return run


def _whole(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame | None:
    """Quantiles of whole columns through sketches; None where a column holds NaN."""
    held, nan = _brackets(df, columns, probs)
    if nan:
        return None
    schema = "feature string, n bigint, q array<double>"
    names = list(held)
    place = {(k, i): (held[c][0] - 1) * p for k, c in enumerate(names) for i, p in enumerate(probs)}
    ends, picked, wanted = [list(held[c][1]) for c in names], {}, set(place)
    while wanted:
        inside = df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(_inside(ends), "k int, i int, v double, c long")
        counts = inside.groupBy(F.struct("k", "i").alias("g"), "v").agg(F.sum("c").alias("c"))          # per bracket: the count below it, without a value, comes first
        if sum(n for n, _ in held.values()) * len(probs) * 2 * MARGIN <= WINDOWED:
            ranked = counts.withColumn("cum_c", F.sum("c").over(Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())))
        else:
            ranked = grouped_prefix_sum(counts, "g", "v", ["c"])
        rank = F.lit([[float(place[k, i]) for i in range(len(probs))] for k in range(len(names))])[F.col("g.k")][F.col("g.i")]

        def at(r: Column) -> Column:
            return F.max(F.when((F.col("cum_c") - F.col("c") <= r) & (r < F.col("cum_c")), F.col("v")))
        for r in ranked.groupBy("g").agg(at(F.floor(rank)).alias("lo"), at(F.ceil(rank)).alias("hi")).collect():               # columns x probs
            if r["lo"] is not None and r["hi"] is not None:
                picked[r["g"]["k"], r["g"]["i"]] = r["lo"], r["hi"]
        wanted = set(place) - set(picked)               # a rank outside its bracket, beyond the sketch's stated error: the whole range is searched
        for k, i in wanted:
            ends[k][i] = (-math.inf, math.inf)
    rows = []
    for k, c in enumerate(names):
        q = []
        for i in range(len(probs)):
            lo, hi = picked[k, i]
            part = place[k, i] - math.floor(place[k, i])
            q.append(lo if lo == hi else lo * (1 - part) + hi * part)
        rows.append((c, held[c][0], q))
    return df.sparkSession.createDataFrame(rows, schema)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(*by, feature, n, q): for each column its non-NULL count and the linearly
    interpolated quantiles ``q`` at ``probs``; columns without a value are not listed.
    NaN counts as greater than all other values."""
    found = None if by else _whole(df, list(columns), [float(p) for p in probs])
    return _grouped(df, columns, probs, list(by)) if found is None else found


def exact_quantile(df: DataFrame, column: str, p: float) -> Column:
    """One quantile of a whole column as a scalar (NULL without values)."""
    return exact_quantiles(df, [column], [p]).agg(F.max(F.col("q")[0])).scalar()

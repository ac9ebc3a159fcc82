"""Connected components of an edge table by alternating large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.session import materialize


def _hook(directed: DataFrame) -> DataFrame:
    """Every neighbour v of u is joined to the least node m of u's neighbourhood."""
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return directed.join(least, "u")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) -> (node, component), the least node reachable.

    Nodes without an edge (or only with themselves) are not listed. Each round
    is two grouped minima and joins (a hub's rows are split by AQE's
    skew join) and is written to the shared folder, so no lineage grows.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u > v").distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_hook(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = _hook(large)
        e = materialize(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(small.select("u", F.col("m").alias("v"))).filter("u > v").distinct(), "cc")
        row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(row):
            break
        before = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Deterministic train / validation / test splits (P-series).

``split_hash`` (default) is stateless: a row's split depends only on its
key, so appends never move old rows and no shuffle is needed.
``split_exact`` reproduces exact split sizes with a distributed global rank
(range-partitioned sort + per-partition offsets), never a single-partition
window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.contract import SPLIT_FRACTIONS, SPLIT_SEED

BUCKETS = 10000


def _check_fractions(fractions) -> tuple[float, float, float]:
    train, val, test = (float(x) for x in fractions)
    total = train + val + test
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"split fractions add up to {total}, not to 1")
    return train, val, test


def hash_key(id_col: str = "record_id", seed: int = SPLIT_SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def hash_bucket(id_col: str = "record_id", seed: int = SPLIT_SEED) -> Column:
    """md5(seed:id) -> first 32 bits -> bucket in [0, 10000)."""
    return F.conv(F.substring(hash_key(id_col, seed), 1, 8), 16, 10).cast("bigint") % BUCKETS


def split_hash(df: DataFrame, fractions=SPLIT_FRACTIONS, seed: int = SPLIT_SEED,
               id_col: str = "record_id", out: str = "split_type") -> DataFrame:
    """P2 + P4: tag rows by hash bucket cut points."""
    train, val, _ = _check_fractions(fractions)
    cut_train = int(round(train * BUCKETS))
    cut_val = int(round((train + val) * BUCKETS))
    b = hash_bucket(id_col, seed)
    tag = F.when(b < cut_train, "train").when(b < cut_val, "validation").otherwise("test")
    return df.withColumn(out, tag)


def exact_sizes(n: int, fractions=SPLIT_FRACTIONS) -> tuple[int, int, int]:
    """Split sizes of two shuffled cuts: the first holds out ceil(n*(1-train)),
    the second gives the test part ceil(holdout*test/(val+test))."""
    train, val, test = _check_fractions(fractions)
    n_hold = math.ceil((1.0 - train) * n) if n else 0
    if val + test <= 0:
        return n, 0, 0
    n_test = math.ceil(test / (val + test) * n_hold)
    return n - n_hold, n_hold - n_test, n_test


def global_rank(df: DataFrame, order_cols: list[str], partitions: int | None = None,
                out: str = "_rank") -> DataFrame:
    """Exact 0-based global rank by ``order_cols`` without a one-partition window.

    Rows are range-partitioned and sorted inside each partition; the
    partition-local position comes from ``monotonically_increasing_id``.
    The per-partition row counts (one number per partition) become offsets.
    The ranged frame is checkpointed to the shared folder so both passes
    see the same partitioning and the lineage survives executor loss."""
    return ranked_with_total(df, order_cols, partitions, out)[0]


def ranked_with_total(df: DataFrame, order_cols: list[str], partitions: int | None = None,
                      out: str = "_rank") -> tuple[DataFrame, int]:
    """`global_rank` plus the row count, taken from the same per-partition counts."""
    spark = df.sparkSession
    from retailcast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(p, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    pid = F.shiftright("_mid", 33)
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = dict(ranged.groupBy(pid.alias("pid")).count().collect())  # <= p rows
    offsets, acc = [], 0
    for i in range(max(counts) + 1 if counts else 0):
        offsets.append(acc)
        acc += counts.get(i, 0)
    offset_col = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), (pid + 1).cast("int")) \
        if offsets else F.lit(0).cast("bigint")
    return ranged.withColumn(out, offset_col + local).drop("_mid"), acc


FINE = 10_000


def _keys_at(keys: DataFrame, id_col: str, fractions) -> dict[str, tuple]:
    """The (key, id) rows at the cut ranks, from counts per key prefix that narrow down."""
    def counts(prefix: str) -> list[tuple[str, int]]:
        rows = keys.filter(F.col("_k").startswith(prefix)).groupBy(F.substring("_k", 1, len(prefix) + 3).alias("p")).count().collect()
        return sorted((r["p"], r["count"]) for r in rows)           # at most 4,096
    top = counts("")
    n = sum(c for _, c in top)
    _, n_val, n_test = exact_sizes(n, fractions)
    out = {}
    for name, rank in (("test", n_test), ("validation", n_test + n_val)):
        if rank >= n:
            continue
        level, left, prefix = top, rank, ""
        while True:
            for prefix, c in level:
                if left < c:
                    break
                left -= c
            if c <= FINE or len(prefix) >= 32:
                row = keys.filter(F.col("_k").startswith(prefix)).orderBy("_k", id_col).limit(left + 1).collect()[-1]
                out[name] = (row["_k"], row[id_col])
                break
            level = counts(prefix)
    return out


def split_exact(df: DataFrame, fractions=SPLIT_FRACTIONS, seed: int = SPLIT_SEED,
                id_col: str = "record_id", out: str = "split_type") -> DataFrame:
    """P1 + P4: exact sizes; membership is a seeded hash order (deterministic).

    Only two cut keys are looked for, over the id column (counts per key prefix,
    then the few keys of the boundary prefix); rows are tagged where they are,
    without a shuffle or a copy."""
    key = hash_key(id_col, seed)
    cuts = _keys_at(df.select(key.alias("_k"), id_col), id_col, fractions)
    here = F.struct(key.alias("k"), F.col(id_col).alias("i"))

    def before(name: str) -> Column:
        return here < F.struct(F.lit(cuts[name][0]).alias("k"), F.lit(cuts[name][1]).alias("i")) if name in cuts else F.lit(True)
    return df.withColumn(out, F.when(before("test"), "test").when(before("validation"), "validation").otherwise("train"))


def sample_cap(df: DataFrame, n: int = 300, seed: int = SPLIT_SEED,
               id_col: str = "record_id") -> DataFrame:
    """P5: deterministic sample of at most ``n`` rows (TakeOrderedAndProject:
    each task keeps its n best rows, so no task holds more than n)."""
    return df.orderBy(hash_key(id_col, seed), F.col(id_col)).limit(n)


def grouped_prefix_sum(df: DataFrame, group: str, order: str | list[str], cols: list[str],
                       partitions: int | None = None) -> DataFrame:
    """Exact running sums of ``cols`` within each ``group`` ordered by ``order``,
    without a per-group window holding a whole group.

    Rows are range-partitioned by (group, order); each partition's per-group
    totals (partitions x groups numbers) give the offsets of earlier
    partitions, and the running sum inside a partition is a window over that
    partition's slice of the group only. The ranged frame is checkpointed so
    both passes see the same partitioning."""
    from pyspark.sql import Window
    spark = df.sparkSession
    from retailcast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [order] if isinstance(order, str) else list(order)
    ranged = (df.repartitionByRange(p, group, *order)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    totals = ranged.groupBy("_pid", group).agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    w_before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", group, *[F.coalesce(F.sum(f"_t_{c}").over(w_before), F.lit(0))
                                              .alias(f"_o_{c}") for c in cols])
    w_in = Window.partitionBy("_pid", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row per (partition, group held there): AQE broadcasts it while it is small
    offsets = offsets.select(F.col("_pid").alias("_p"), F.col(group).alias("_g"), *[f"_o_{c}" for c in cols])
    return (ranged.join(offsets, (F.col("_pid") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
            .select(*[c for c in df.columns],
                    *[(F.col(f"_o_{c}") + F.sum(c).over(w_in)).alias(f"cum_{c}") for c in cols]))

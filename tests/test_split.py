from pyspark.sql import functions as F

from retailcast.operators import split as P


def test_exact_sizes_reference():
    assert P.exact_sizes(500) == (450, 25, 25)
    assert P.exact_sizes(53307) == (53307 - 5331, 2665, 2666)
    assert P.exact_sizes(0) == (0, 0, 0)


def test_fraction_check():
    import pytest
    with pytest.raises(ValueError):
        P.exact_sizes(10, (0.5, 0.2, 0.2))


def test_split_exact_distributed(spark):
    df = spark.range(500).withColumnRenamed("id", "record_id")
    a = P.split_exact(df.repartition(7))
    counts = dict(a.groupBy("split_type").count().collect())
    assert counts == {"train": 450, "validation": 25, "test": 25}
    b = P.split_exact(df.repartition(3))
    assert a.exceptAll(b).count() == 0           # deterministic, partitioning-independent
    assert a.select("record_id").distinct().count() == 500


def test_global_rank_matches_sort(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    r = P.global_rank(df, ["v", "id"], partitions=5)
    got = [x["v"] for x in r.orderBy("_rank").collect()]
    assert got == sorted(got)
    assert [x["_rank"] for x in r.orderBy("_rank").collect()] == list(range(1000))


def test_split_hash_stable_under_append(spark):
    a = P.split_hash(spark.range(1000).withColumnRenamed("id", "record_id"))
    b = P.split_hash(spark.range(2000).withColumnRenamed("id", "record_id")).filter("record_id < 1000")
    assert a.exceptAll(b).count() == 0


def test_sample_cap(spark):
    df = spark.range(5000).withColumnRenamed("id", "record_id")
    s = P.sample_cap(df, 300)
    assert s.count() == 300
    assert sorted(r[0] for r in s.collect()) == sorted(r[0] for r in P.sample_cap(df.repartition(5), 300).collect())


def test_grouped_prefix_sum(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 3000).alias("v"),
                                  (F.col("id") % 5).alias("x"))
    got = {(r["g"], r["v"]): r["cum_x"] for r in P.grouped_prefix_sum(df, "g", "v", ["x"], partitions=7).collect()}
    rows = sorted((r["g"], r["v"], r["x"]) for r in df.collect())
    acc = {}
    for g, v, x in rows:
        acc[g] = acc.get(g, 0) + x
        assert got[(g, v)] == acc[g]


def test_prefix_sum_splits_a_hot_group(spark):
    # one group holds 90% of the rows; range partitioning spreads it over tasks
    df = spark.range(20000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 3 + 1).otherwise(0).alias("g"),
                                   F.col("id").alias("v"), F.lit(1).alias("x"))
    out = P.grouped_prefix_sum(df, "g", "v", ["x"], partitions=8)
    per_task = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(per_task) < 0.25 * 20000                       # no task holds the hot group whole
    hot = out.filter("g = 0").agg(F.max("cum_x")).first()[0]
    assert hot == 18000                                        # and the running sum is still exact


def test_split_exact_narrows_down_by_prefix(spark, monkeypatch):
    """Boundary prefixes with more keys than FINE are counted again by a longer prefix."""
    df = spark.range(3000).withColumnRenamed("id", "record_id")
    a = P.split_exact(df)
    monkeypatch.setattr(P, "FINE", 0)
    b = P.split_exact(df)
    assert a.exceptAll(b).count() == 0
    assert dict(a.groupBy("split_type").count().collect()) == {"train": 2700, "validation": 150, "test": 150}

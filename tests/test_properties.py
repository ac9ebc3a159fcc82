"""Property tests against plain-Python definitions (small random inputs)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from retailcast.operators import bias as B
from retailcast.operators import split as P


def _py_pre(c):
    """Pre-training metrics from counts {(facet_is_d, label): n}."""
    na = c[(0, 0)] + c[(0, 1)]
    nd = c[(1, 0)] + c[(1, 1)]
    pa = [c[(0, y)] / na for y in (0, 1)]
    pd = [c[(1, y)] / nd for y in (0, 1)]

    def kl(p, q):
        if any(pi > 0 and qi == 0 for pi, qi in zip(p, q)):
            return None
        return sum(pi * math.log(pi / qi) for pi, qi in zip(p, q) if pi > 0)
    m = [(x + y) / 2 for x, y in zip(pa, pd)]
    return {"ci": (na - nd) / (na + nd), "dpl": pa[1] - pd[1], "kl": kl(pa, pd),
            "js": (kl(pa, m) + kl(pd, m)) / 2, "ks": max(abs(x - y) for x, y in zip(pa, pd)),
            "lp": math.sqrt(sum((x - y) ** 2 for x, y in zip(pa, pd))),
            "tvd": sum(abs(x - y) for x, y in zip(pa, pd)) / 2}


@settings(max_examples=8, deadline=None)
@given(st.tuples(*[st.integers(0, 6)] * 4).filter(lambda t: t[0] + t[1] > 0 and t[2] + t[3] > 0))
def test_pretraining_matches_definition(spark, counts):
    c = dict(zip([(0, 0), (0, 1), (1, 0), (1, 1)], counts))
    rows = [(f, y) for (f, y), n in c.items() for _ in range(n)]
    got = B.pretraining_bias(spark.createDataFrame(rows, "is_weekend int, high_demand int")).first()
    exp = _py_pre(c)
    for k, v in exp.items():
        if v is None:
            assert got[k] is None
        else:
            assert abs(got[k] - v) < 1e-12, (k, got[k], v)


@given(st.integers(0, 100000), st.sampled_from([(0.9, 0.05, 0.05), (0.8, 0.1, 0.1), (0.7, 0.3, 0.0),
                                                (1.0, 0.0, 0.0), (0.6, 0.15, 0.25)]))
def test_exact_sizes_partition_n(n, fr):
    tr, va, te = P.exact_sizes(n, fr)
    assert tr + va + te == n and min(tr, va, te) >= 0
    if fr[1] == 0 and fr[2] == 0:
        assert (va, te) == (0, 0)


@settings(max_examples=5, deadline=None)
@given(st.integers(1, 400), st.integers(1, 9))
def test_split_exact_sizes_distributed(spark, n, parts):
    df = spark.range(n).withColumnRenamed("id", "record_id")
    got = dict(P.split_exact(df).groupBy("split_type").count().collect())
    tr, va, te = P.exact_sizes(n)
    assert got.get("train", 0) == tr and got.get("validation", 0) == va and got.get("test", 0) == te

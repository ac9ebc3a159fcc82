"""Hard-negative mining and vector codes against brute force, and their odd rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailcast.llm import hilbert_pq, intvec, onebit

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows, scale):
    return [(i, np.floor(scale * np.float32(v).astype(np.float64)).astype(object), y) for i, v, y in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]


def vectors(n, d, seed, labels=3, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.standard_normal(d).astype(np.float32)], int(rng.integers(labels))) for i in range(n)]
    return rows + [(n + i, rows[i % 3][1], rows[i % 5][2]) for i in range(copies)]


def mined(rows, every, positives, negatives, share):
    """Plain loops over Python integers."""
    v = [(i, [int(t) for t in x], y) for i, x, y in usable(rows, 256) if i is not None and y is not None]
    out = []
    for i, x, y in sorted(v):
        if i % every:
            continue
        score = [(-sum(a * b for a, b in zip(x, e)), j, z) for j, e, z in v if j != i and len(e) == len(x)]
        best = sorted((s, j) for s, j, z in score if z == y)[:positives]
        for s, j in best:
            held = sorted((t, m) for t, m, z in score if z != y and share[0] * -s <= 100 * -t <= share[1] * -s)[:negatives]
            out += [(i, j, r + 1, m, -s, -t) for r, (t, m) in enumerate(held)]
    return sorted(out)


def mine(spark, rows, **how):
    found = onebit.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), **how).select(*onebit.RESULT)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("share", [(30, 90), (-50, 120)])
def test_hard_negatives_equal_brute_force(spark, share):
    rows = vectors(220, 20, 5, copies=60) + [(900, None, 1), (901, [1.0] * 20, None), (902, [float("nan")] * 20, 1), (903, [float("inf")] * 20, 2),
                                             (904, [None] * 20, 2), (910, [0.0] * 20, 1), (911, [], 1), (920, [], 2), (930, [1.0, 2.0], 0), (931, [1.0, 2.0], 0), (932, [1.0, 1.0], 1)]
    how = {"every": 10, "positives": 3, "negatives": 4, "share": share}
    assert mine(spark, rows, **how) == mined(rows, **how)


def test_hard_negatives_of_repeated_rows_and_several_blocks(spark, monkeypatch):
    rows = vectors(120, 70, 6)
    monkeypatch.setattr(onebit, "ANCHOR_BLOCK", 5)
    how = {"every": 4, "positives": 5, "negatives": 10, "share": (30, 90)}
    want = mined(rows, **how)
    assert mine(spark, rows, **how) == want
    assert mine(spark, rows + rows[:40] + rows[:40], **how) == want
    odd = spark.createDataFrame([(i, v, y, 7, "x") for i, v, y in rows] + [(None, rows[0][1], 1, 7, "x")], SCHEMA + ", anchor_id int, code string")
    assert sorted(tuple(r) for r in onebit.hard_negatives(odd, **how).select(*onebit.RESULT).collect()) == want


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert onebit.hard_negatives(none).collect() == [] and hilbert_pq.compress(none).collect() == []
    unusable = spark.createDataFrame([(0, None, 1), (100, [None], 1)], SCHEMA)
    assert onebit.hard_negatives(unusable).collect() == [] and hilbert_pq.compress(unusable).collect() == []


def test_intervals_hold_the_products():
    rng = np.random.default_rng(3)
    for d in (1, 7, 64, 130):
        x = np.floor(256 * rng.standard_normal((300, d)))
        length, rest, align, code = onebit.encode(x)
        part = type("P", (), {"ids": np.arange(300), "length": length, "rest": rest, "align": align, "code": code})()
        anchors = onebit.Anchors(np.arange(40), np.zeros(40), x[:40])
        low, high = anchors.bounds(np.arange(40), part)
        true = x[:40] @ x.T
        assert (low <= true).all() and (true <= high).all()
        if d == 64:       # the rounds leave intervals far narrower than the vectors' lengths
            assert np.median((high - low) / (anchors.length[:, None] * length)) < 0.25


def test_large_components_are_exact_or_raise(spark):
    big = 2.0**40
    rows = [(i, [big * (1 + i % 7), float(i)], i % 2) for i in range(0, 60)]
    how = {"every": 10, "positives": 2, "negatives": 3, "share": (1, 400)}
    with pytest.raises(Exception, match="beyond a long"):
        mine(spark, rows, **how)
    rows = [(i, [2.0**18 * (1 + i % 7), float(i)], i % 2) for i in range(0, 60)]
    assert mine(spark, rows, **how) == mined(rows, **how)
    a = np.array([[2.0**31, 3.0]])
    assert intvec.products(a, a)[0, 0] == 2**62 + 9 and intvec.row_products(a, a)[0] == 2**62 + 9


def quantised(rows, entries=256, rounds=4):
    """Lloyd rounds in Python integers, for one vector length."""
    v = usable(rows, 1024)
    d = len(v[0][1])
    w = d // 4
    first = sorted(v, key=lambda r: (r[0] is None, r[0], list(r[1])))[:entries]
    books = [[list(map(int, r[1][p * w:(p + 1) * w])) for r in first] for p in range(4)]
    cut = [[list(map(int, r[1][p * w:(p + 1) * w])) for p in range(4)] for r in v]

    def at(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(4):
            groups = {}
            for c in cut:
                groups.setdefault(at(p, c[p])[1], []).append(c[p])
            new.append([[sum(col) // len(groups[k]) for col in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], {}
    for (i, _, y), c in zip(v, cut):
        best = [at(p, c[p]) for p in range(4)]
        error = sum(b[0] for b in best)
        total[y] = total.get(y, 0) + error
        out.append([i, "".join(f"{b[1]:02x}" for b in best), error, y])
    return sorted((i, code, e, total[y], digest) for i, code, e, y in out)


def codes(spark, rows, **how):
    return sorted(tuple(r) for r in hilbert_pq.compress(spark.createDataFrame(rows, SCHEMA).repartition(4), **how).collect())


def test_vector_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hilbert_pq, "ENTRIES", 9)
    rows = [(i, v, y if i % 11 else None) for i, v, y in vectors(150, 12, 8, copies=150)] + [(400, None, 1), (401, [float("inf")] * 12, 1), (402, [None] + [1.0] * 11, 1)]
    want = quantised(rows, entries=9)
    assert codes(spark, rows) == want
    # equal points, fewer rows than entries, large components
    same = [(i, [1.5, -2.5, 0.0, 3.0], 0) for i in range(40)]
    assert codes(spark, same) == quantised(same, entries=9)
    few = [(5, [1.0, 2.0, 3.0, 4.0], 1), (3, [2.0, 2.0, 3.0, 4.0], 1)]
    assert codes(spark, few) == quantised(few, entries=9)
    large = [(i, [float(2**18 + i * 5000), 1.0 * i, -float(2**17), 0.25 * i], i % 2) for i in range(40)]
    assert codes(spark, large) == quantised(large, entries=9)


def test_vector_codes_of_other_lengths_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(hilbert_pq, "ENTRIES", 4)
    a, b = vectors(30, 8, 1), [(i + 500, v, y) for i, v, y in vectors(20, 4, 2)]
    found = {r[0]: r for r in codes(spark, a + b + [(900, [1.0, 2.0], 1)])}
    assert found[900][1] is None and found[900][2] is None and found[900][4] is None
    for part in (a, b):
        assert [found[i][1:3] for i, *_ in quantised(part, 4)] == [r[1:3] for r in quantised(part, 4)]
        assert {found[i][4] for i, *_ in part} == {quantised(part, 4)[0][4]}
    twice = codes(spark, a + a[:10])
    assert len(twice) == 40 and twice == quantised(a + a[:10], 4)


def test_hilbert_keys_are_a_curve():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        key = hilbert_pq.hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_shortlists_keep_the_nearest_entry():
    rng = np.random.default_rng(4)
    for spread in (1, 30, 1000):
        x, entries = rng.integers(-spread, spread, (50, 4)).astype(float), rng.integers(-300, 300, (40, 4)).astype(float)
        some = hilbert_pq.shortlist(x.min(axis=0), x.max(axis=0), entries)
        best, distance = hilbert_pq.nearest(x, entries)
        assert set(best) <= set(some) and (some[hilbert_pq.nearest(x, entries[some])[0]] == best).all()
        assert (distance == ((x - entries[best]) ** 2).sum(axis=1)).all()

"""The join against brute force, by property and on the driver's documents."""

import random
import re

import numpy as np
import pytest

from retailcast.llm import ngram_join as J
from retailcast.llm import textvec as V
from tests.conftest import SF0001
from tests.llm.conftest import ODD_TEXTS, frame


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect() if r["doc_id"] is not None)


def families(seed, n=160):
    """Copies with edits around the threshold, a shared passage, and short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    out = []
    while len(out) < n:
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 30, 90]))]
        if rng.random() < 0.5:
            base = passage.split() + base
        for _ in range(rng.choice([1, 1, 2, 12])):
            own = list(base)
            for _ in range(rng.randrange(0, max(1, len(own) // 18) + 1)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own).upper() if rng.random() < 0.1 else " ".join(own))
    return out[:n]


@pytest.mark.parametrize("seed", [1, 2])
def test_families_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(J, "SMALL_RUN", 4)      # the paths of frequent keys and of several tiles, on few rows
    monkeypatch.setattr(J, "TILE", 16)
    monkeypatch.setattr(J, "BLOCK", 8)
    texts = families(seed)
    assert got(frame(spark, texts)) == brute(list(enumerate(texts)))


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark, odd_docs, no_docs):
    rows = J.jaccard_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by[0] == {(0, 0)} and by[1] == {(0, 1)} and by[5] == {(1, 3)} and by[None] == {(2, None)}
    assert {len(shingles(t)) for t in ODD_TEXTS} >= {n for i, s in by.items() if i is not None for n, _ in s}
    assert J.jaccard_components(no_docs).count() == 0


def test_bounds_lose_no_link():
    """The tree lets through every pair that links."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300).astype(V.U)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(20, 300), replace=False), rng.integers(0, 2**63, rng.integers(0, 40)).astype(V.U)])) for _ in range(120)]
    n = np.array([len(s) for s in sets])
    counts = np.stack([np.bincount((s >> J.GROUP_SHIFT).astype(int), minlength=J.GROUPS) for s in sets])
    tree = J.CountTree(counts, n)
    pairs = {(i, j) for i in range(120) for j in range(120) if i != j and J.linked(sets[i], sets[j])}
    assert pairs and pairs <= {(i, int(j)) for i in range(120) for j in tree.near(counts[i], n[i])}
    exact = {(i, j) for i, j in pairs if 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))}
    assert exact == pairs

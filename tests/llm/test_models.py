"""Classifiers, the pivot search and the codec: held-out accuracy, brute force, round trips."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from retailcast.llm import dsir, pivot_topk, sp_codec, toxicity
from retailcast.llm.queries import ORACLE_SQL, SP_MODEL, op6_pivot_topk
from tests.conftest import SF0001
from tests.llm.conftest import ODD_TEXTS, frame

BAD = ["blorgel", "snarkit", "vexmud"]


def labelled(spark, n=600, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ba", "lo", "ti", "mer", "su", "pan", "ke"]) for _ in range(rng.choice([1, 2, 3]))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.choice([5, 40, 300]))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                word = rng.choice(BAD)
                if i % 3 == 0:                                      # a misspelling that shares most of its letters
                    word = word[:-1] + rng.choice("abcdez") + word[-1]
                text.insert(rng.randrange(len(text)), word)
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), {i: y for i, _, y in rows}


def test_toxicity_held_out_accuracy(spark):
    docs, labels, truth = labelled(spark)
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    caught = [r["predicted"] for r in held if truth[r["doc_id"]]]
    wrong = [r["predicted"] for r in held if not truth[r["doc_id"]]]
    assert np.mean(caught) > 0.9 and np.mean(wrong) < 0.03


def test_toxicity_never_sees_the_held_out_fold(spark):
    docs, labels, _ = labelled(spark, 200)
    fold = toxicity.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_toxicity_score_is_the_model_itself(spark):
    """Folding embeddings and softmax into one score for each n-gram changes nothing."""
    docs, labels, truth = labelled(spark, 120)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    table, bias = toxicity.train(texts, np.array([truth[i] for i in range(120)]))
    got = next(iter(toxicity._score_pass(table, bias)([pa.RecordBatch.from_arrays([pa.array(range(3)), pa.array(texts[:2] + [""])], ["doc_id", "text"])]))).column(1).to_pylist()
    assert abs(got[2] - 1 / (1 + math.exp(-bias))) < 1e-9 and truth[0] and got[0] > got[1]


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    _, labels, _ = labelled(spark, 60)
    docs, none = labelled(spark, 60)[0], labels.limit(0)
    rows = toxicity.toxicity(odd_docs.unionByName(docs, allowMissingColumns=True), labels).collect()
    assert len(rows) == odd_docs.count() + 60 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.toxicity(no_docs, labels).count() == 0 and toxicity.toxicity(odd_docs, none).count() == odd_docs.count()


def corpus(spark, n=400, seed=8):
    rng = random.Random(seed)
    words = [f"wo{i}rd" for i in range(200)]
    rows = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.choice([4, 30, 200]))]
        good = i % 4 > 0
        if not good:
            own = [w + rng.choice(["***", "###"]) for w in own] if i % 8 == 0 else [w for w in own for _ in range(6)]
        rows.append((i, " ".join(own), int(good)))
    return (spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"),
            spark.createDataFrame([(i, q) for i, _, q in rows if i % 2], "doc_id long, quality int").unionByName(
                spark.createDataFrame([(i, q) for i, _, q in rows if i % 2 == 0], "doc_id long, quality int")), {i: q for i, _, q in rows})


def test_quality_keeps_good_and_drops_bad(spark):
    docs, labels, truth = corpus(spark)
    kept = {r["doc_id"] for r in dsir.quality_filter(docs, labels.filter("doc_id % 3 > 0")).collect()}
    good = [i for i, q in truth.items() if q]
    bad = [i for i, q in truth.items() if not q]
    assert np.mean([i in kept for i in good]) > 0.98 and np.mean([i in kept for i in bad]) < 0.1


def test_log_weights_match_plain_counts(spark):
    """The weight is the sum over n-grams of the models' log ratio, counted here one by one."""
    docs, labels, _ = corpus(spark, 60)
    sample = dsir.label_sample(labels)
    ratio = dsir.fit(docs, sample)
    target = {r["doc_id"] for r in sample.filter("fit and good").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    own = {}
    for i, t in texts.items():
        own[i] = dsir.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0].tolist()
        assert len(own[i]) == 4 * len(t.split()) - 2
    raw, good = np.zeros(dsir.BUCKETS), np.zeros(dsir.BUCKETS)
    for i, b in own.items():
        for x in b:
            raw[x] += 1
            good[x] += i in target
    want = np.log(good + dsir.PRIOR) - np.log(raw * good.sum() / raw.sum() + dsir.PRIOR)
    want[np.abs(want) < dsir.MARGIN] = 0
    np.testing.assert_allclose(ratio, want, atol=1e-9)
    for r in dsir.score(docs, ratio, 17).collect():
        n = len(own[r["doc_id"]])
        assert abs(r[dsir.LOG_WEIGHT] - sum(want[x] for x in own[r["doc_id"]]) * min(1, dsir.LENGTH / n)) < 1e-6


def test_unbent_log_weights_are_the_plain_sum(spark):
    """With ``length`` and ``margin`` off a weight is the sum of log ratios of words counted here
    (no bucket holds two n-grams of so few), and other ids and columns come back as they were."""
    docs = frame(spark, ["aa bb aa", "aa cc " * 200, "dd ee ff gg", "", None]).withColumnRenamed("doc_id", "key").withColumn("doc_id", F.lit(7))
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "key long, quality int")
    scored, _ = dsir.resample(docs, labels, id_col="key", k=3, length=None, margin=0.0)
    assert scored.columns == [*docs.columns, dsir.LOG_WEIGHT, dsir.KEY]
    rows = {r["key"]: r for r in scored.collect()}
    assert all(r["doc_id"] == 7 for r in rows.values()) and rows[3][dsir.LOG_WEIGHT] == rows[4][dsir.LOG_WEIGHT] == 0
    fitted = {r["doc_id"] for r in dsir.label_sample(labels, "key").filter("fit and good").collect()}
    shape = lambda a, b: ("again" if a == b else "", len(b))
    grams = {}
    for i, t in enumerate(["aa bb aa", "aa cc " * 200, "dd ee ff gg", "", ""]):
        w = t.split()
        own = [*w, *zip(w, w[1:], strict=False)]
        shapes = [shape(a, b) for a, b in zip([None, *w], w, strict=False)]
        grams[i] = own + [("shape", x) for x in shapes] + [("shapes", a, b) for a, b in zip(shapes, shapes[1:], strict=False)]
    raw, good = Counter(g for own in grams.values() for g in own), Counter(g for i, own in grams.items() if i in fitted for g in own)
    share = sum(good.values()) / sum(raw.values())
    for i, own in grams.items():
        want = sum(math.log(good[g] + dsir.PRIOR) - math.log(raw[g] * share + dsir.PRIOR) for g in own)
        assert abs(rows[i][dsir.LOG_WEIGHT] - want) < 1e-6


def test_gumbel_top_k_is_exact_and_samples_by_weight(spark, monkeypatch):
    keys = spark.range(5000).withColumn(dsir.KEY, F.rand(3) * F.when(F.col("id") % 7 == 0, 100).otherwise(1))
    all_keys = sorted((r[0] for r in keys.select(dsir.KEY).collect()), reverse=True)
    monkeypatch.setattr(dsir, "FINE", 40)
    for k in (1, 700, 2500, 5000):
        assert dsir.kth_largest(keys, k) == all_keys[k - 1]
    assert dsir.kth_largest(keys, 0) == math.inf and dsir.kth_largest(keys, 9999) == -math.inf
    # the noise is Gumbel: of pairs with log weights 0 and log 3 the second wins three times in four
    docs = frame(spark, [f"t{i}" for i in range(8000)])
    noise = np.array([r[dsir.KEY] for r in dsir.score(docs, np.zeros(dsir.BUCKETS), 17).orderBy("doc_id").collect()])
    assert abs(np.mean(noise[1::2] + np.log(3) > noise[::2]) - 0.75) < 0.03


def test_quality_odd_rows(spark, odd_docs, no_docs):
    docs, labels, _ = corpus(spark, 40)
    assert dsir.quality_filter(no_docs, labels).count() == 0
    scored, least = dsir.resample(odd_docs, labels)
    assert scored.count() == odd_docs.count() and dsir.resample(odd_docs, labels.limit(0))[1] <= scored.agg(F.min(dsir.KEY)).first()[0] + 1e9
    assert dsir.quality_filter(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert dsir.quality_filter(odd_docs, labels).columns == odd_docs.columns


def plain_top(rows, k=5, every=50):
    v = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q in sorted({i for i, _ in v if i % every == 0}):
        best = {}
        for _, a in [x for x in v if x[0] == q]:
            for i, b in v:
                if i != q and len(a) == len(b):
                    s = sum(x * y for x, y in zip(a, b, strict=True))
                    best[i] = max(best.get(i, s), s)
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return out


def test_top_k_matches_plain(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(pivot_topk, "STEP", 8)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 6).round(2)]) for i in range(0, 420)]
    rows += [(500, None), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [math.nan] * 6), (650, [math.inf] * 6), (None, [1.0] * 6), (700, [1.0, 2.0]), (701, [3.0, -1.0]),
             (50, rows[50][1]), (51, rows[51][1]), (100, [9.0] * 6), (750, []), (800, [])] + [(1000 + i, rows[7][1]) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = sorted(map(tuple, pivot_topk.top_k(df).collect()))
    assert got == plain_top(rows)
    assert pivot_topk.top_k(df.limit(0)).count() == 0


def test_top_k_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF0001}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLE_SQL['op6_pivot_topk']})").fetchall())
    assert sorted(map(tuple, op6_pivot_topk(spark, SF0001).collect())) == want


TEXTS = ODD_TEXTS[1:] + ["Hello,  world!!  don't", "a" * 200, "ab" * 300 + " " + "z" * 60, " lead and trail ", "日本語のテキストです。漢字", "naïve ① \x00 \U0001f642\U0001f642",
                         "def f(x):\n    return x ** 2  # ok\n", "ÀÉÎ" * 30, "https://example.org/a?b=c&d=1234567890"]


@pytest.fixture(scope="module")
def codec():
    return sp_codec.Codec(sp_codec.model_bytes(SP_MODEL))


def random_texts(n, seed):
    rng = random.Random(seed)
    pools = ["etaoin shrdlu  .,'\n01", "".join(map(chr, range(32, 127))), "".join(map(chr, [*range(160, 700), 32, 0x4E00, 0x4E8C, 0x1F600])), "aab "]
    return ["".join(rng.choice(p) for _ in range(rng.randrange(120))) for p in pools for _ in range(n)]


def test_ids_equal_the_library(codec):
    texts = TEXTS + random_texts(150, 2)
    ids, rows = codec.encode(texts)
    want = sentencepiece.SentencePieceProcessor(model_file=SP_MODEL).encode(texts, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)] == want
    data, ends = codec.decode(ids, rows)
    assert [data[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [t.replace("▁", " ") for t in texts]


def test_unigram_models_are_plain_viterbi():
    """The same pieces read as a unigram model: the library's own Viterbi gives the same total score."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto.FromString(sp_codec.model_bytes(SP_MODEL))
    model.trainer_spec.model_type = 1
    for i, p in enumerate(model.pieces):
        p.score = -math.log(i + 2) if p.type == 1 else p.score
    proto = model.SerializeToString()
    lib, own = sentencepiece.SentencePieceProcessor(model_proto=proto), sp_codec.Codec(proto)
    for text in ["the quick brown fox", "internationalization of things", "a b  c", "Thndinth ertion"]:
        ids, _ = own.encode([text])
        score = lambda x: sum(lib.get_score(int(i)) for i in x)
        assert abs(score(ids) - score(lib.encode(text))) < 1e-4 and lib.decode([int(i) for i in ids]) == text


def test_encode_and_decode_frames(spark, odd_docs, no_docs):
    proto = sp_codec.model_bytes(SP_MODEL)
    rows = sp_codec.encode(odd_docs, proto)
    got = rows.collect()
    assert len(got) == odd_docs.count() and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    back = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in sp_codec.decode(rows, proto).collect())
    assert back == sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in odd_docs.collect())
    assert sp_codec.encode(no_docs, proto).count() == 0 and sp_codec.decode(sp_codec.encode(no_docs, proto), proto).count() == 0
    lossy = sp_codec.encode(frame(spark, ["a▁b"]), proto).first()
    assert not lossy["round_trip"]


def test_decode_reads_null_and_unknown_ids(spark):
    proto = sp_codec.model_bytes(SP_MODEL)
    ids = sp_codec.encode(frame(spark, ["one two"]), proto).first()["ids"]
    rows = spark.createDataFrame([(1, ids), (2, [ids[0], None, 10**9, -5]), (3, [None]), (4, None)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in sp_codec.decode(rows, proto).collect()}
    assert got[1] == "one two" and got[2].endswith("\ufffd\ufffd\ufffd") and not got[2].startswith("\ufffd") and got[3] == "\ufffd" and got[4] == ""
